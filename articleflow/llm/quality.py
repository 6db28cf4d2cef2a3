"""Quality rules: exact base counts with fixed limits, then a calibrated linear classifier.

Features are hashed: words and pairs of words in one half of DIM places, byte 3- and 5-grams in
the other; a place holds log(1 + count), and each half has length one.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.llm.common import LOWER, add_columns, raw
from articleflow.llm.logistic import Logistic, train
from articleflow.llm.textstats import counts

HALF = 1 << 15
DIM = 2 * HALF
# Bound of the fit: labelled rows of each label.
PER_LABEL = 1500
# Fixed limits of the rules.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MIN_PROBABILITY = 0.5


def _unit(hits: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(hits, minlength=HALF)
    at = np.flatnonzero(n)
    v = np.log1p(n[at])
    return (at + base).astype(np.int32), (v / max(float(np.sqrt(v @ v)), 1e-9)).astype(np.float32)


def features(text: bytes, words: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features; nothing for a text without words."""
    low = text.translate(LOWER)
    words = low.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    one = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    two = (one[:-1] * np.uint32(0x9E3779B1)) ^ (one[1:] * np.uint32(0x85EBCA77))
    word_hits = np.concatenate([one, two]) * np.uint32(0xC2B2AE35) >> np.uint32(17)
    b = np.frombuffer(low, np.uint8).astype(np.uint32)
    grams = []
    for size in (3, 5):
        if len(b) >= size:
            h = np.zeros(len(b) - size + 1, np.uint32)
            for i in range(size):
                h = h * np.uint32(0x01000193) + b[i : len(b) - size + 1 + i] + np.uint32(size)
            grams.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(17))
    word_part = _unit(word_hits, 0)
    if not grams:
        return word_part
    char_part = _unit(np.concatenate(grams), HALF)
    return np.concatenate([word_part[0], char_part[0]]), np.concatenate([word_part[1], char_part[1]])


def sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, per_label: int) -> DataFrame:
    """Labelled rows (text, y), at most ``per_label`` of each label by a hash of the id."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    known = known.distinct().withColumn("h", F.xxhash64("id"))
    rank = F.row_number().over(Window.partitionBy("y").orderBy("h", "id"))
    chosen = known.withColumn("rank", rank).where(F.col("rank") <= per_label).select("id", "y", "h")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), "id")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", per_label: int = PER_LABEL) -> Logistic:
    """Classifier from at most twice ``per_label`` labelled rows; the driver gets hashed features only."""

    def make():
        def work(column):
            got = [features(t) for t in raw(column)]
            return [[p.tobytes() for p, _ in got], [v.tobytes() for _, v in got]]

        return work

    fields = [T.StructField("places", T.BinaryType()), T.StructField("values", T.BinaryType())]
    rows = add_columns(sample(docs, labels, text, doc_id, label, per_label), fields, make, ["text"], ["h", "y"])
    got = rows.orderBy("h", "y", "places").limit(2 * per_label).collect()
    data = [(np.frombuffer(r["places"], np.int32), np.frombuffer(r["values"], np.float32)) for r in got]
    return train(data, np.array([r["y"] for r in got]), DIM)


def judge(
    docs: DataFrame,
    model: Logistic,
    text: str = "text",
    keep: list[str] | None = None,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """``docs`` with the base counts, base_failed, quality (probability of label 1) and kept.

    Null and empty texts have no words, so they fail the base rule. A text that passes is kept
    if its probability reaches ``min_probability``; with no labels at all that probability is one
    half. Whole texts are read; rows are independent, so repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def work(column):
            rows = []
            for t in raw(column):
                words, chars, symbols, lines, again = counts(t)
                failed = len(words) < min_words or 100 * again > max_repeated_percent * len(words)
                p = float(m.probability(m.margin(*features(t))))
                rows.append((len(words), chars, symbols, lines, again, failed, p, not failed and p >= min_probability))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in fields]

        return work

    long, flag = T.LongType(), T.BooleanType()
    fields = [T.StructField(n, long) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [T.StructField("base_failed", flag), T.StructField("quality", T.DoubleType()), T.StructField("kept", flag)]
    return add_columns(docs, fields, make, [text], keep)
