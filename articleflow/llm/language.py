"""Language identification with string kernels.

A text is the set of its byte n-grams of lengths 1 to 4 (blended spectrum, presence only), hashed
into DIM places. The kernel of two texts is the cosine of their sets. Landmark texts give the
Nyström map; one ridge regression for each language is fitted on mapped texts, and a batch is
scored by two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.llm.common import add_columns, raw

DIM = 1 << 14
LENGTHS = (1, 2, 3, 4)
# Bounds of the fit: rows of each language, rows in all, landmark texts.
PER_LANG = 600
SAMPLE = 3000
LANDMARKS = 96
RIDGE = 1.0
UNKNOWN = "und"
# Texts whose kernel rows are computed together.
ROWS = 256


def presence(text: bytes) -> np.ndarray:
    """Places of the n-grams of the lower-cased text, marked once each."""
    b = np.frombuffer(text.decode("utf-8", "replace").lower().encode(), np.uint8).astype(np.uint32)
    seen = np.zeros(DIM, bool)
    code = np.zeros(len(b), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        if len(b) < n:
            break
        code = (code[: len(b) - n + 1] << np.uint32(8)) | b[n - 1 :]
        if n in LENGTHS:
            seen[((code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(18)] = True
    return seen


def unit_rows(texts: list[bytes]) -> np.ndarray:
    rows = np.zeros((len(texts), DIM), np.float32)
    for i, t in enumerate(texts):
        rows[i] = presence(t)
    return rows / np.maximum(np.sqrt(rows.sum(1, keepdims=True)), 1.0)


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # DIM x landmarks
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def margins(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.landmarks) @ self.weights + self.bias


def sample(df: DataFrame, text: str, lang: str, order: str) -> DataFrame:
    """At most PER_LANG rows of each language and SAMPLE in all, by a hash of ``order``.

    Only ids and languages are ranked; a language with very many rows is cut to its first rows
    in each task before the shuffle.
    """
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(order).alias("id"))
    known = known.withColumn("h", F.xxhash64("id"))
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id")))
    chosen = ranked.where(F.col("rank") <= PER_LANG).orderBy("rank", "h", "id").limit(SAMPLE)
    wanted = F.broadcast(chosen.select(F.col("id").alias("wanted")).distinct())
    return df.select(F.col(order).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).join(wanted, F.col("id") == F.col("wanted"), "left_semi").where("lang is not null and text is not null")


def fit(df: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id") -> Model | None:
    """Model from a bounded sample of ``df``; None if no row has both text and language.

    The driver gets one bit set of DIM places for each sampled text.
    """

    def make():
        return lambda column: [[np.packbits(presence(t)).tobytes() for t in raw(column)]]

    got = add_columns(sample(df, text, lang, order), [T.StructField("bits", T.BinaryType())], make, ["text"], ["id", "lang"])
    got = got.orderBy(F.xxhash64("id"), "lang").limit(SAMPLE).collect()
    if not got:
        return None
    langs = sorted({r.lang for r in got})
    place = {name: i for i, name in enumerate(langs)}
    rows = np.unpackbits(np.frombuffer(b"".join(bytes(r.bits) for r in got), np.uint8).reshape(len(got), -1), axis=1).astype(np.float32)
    rows /= np.maximum(np.sqrt(rows.sum(1, keepdims=True)), 1.0)
    y = np.array([place[r.lang] for r in got])
    # Landmarks: the languages in turn, so that a rare one has some.
    turn = np.zeros(len(y), np.int64)
    for k in range(len(langs)):
        turn[y == k] = np.arange((y == k).sum())
    chosen = np.lexsort((y, turn))[:LANDMARKS]
    marks = rows[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])  # inverse root of the landmark kernel
    mapped = (rows @ marks.T).astype(np.float64) @ half
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    # Each language weighs the same, whatever its share of the sample.
    weight = 1.0 / np.bincount(y, minlength=len(langs))[y]
    weight *= len(y) / weight.sum()
    mean = (weight @ mapped) / weight.sum()
    middle = (weight @ target) / weight.sum()
    x = mapped - mean
    w = np.linalg.solve(x.T @ (x * weight[:, None]) + RIDGE * np.eye(x.shape[1]), x.T @ ((target - middle) * weight[:, None]))
    return Model(langs, np.ascontiguousarray(marks.T), (half @ w).astype(np.float32), (middle - mean @ w).astype(np.float32))


def predict(df: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with lang_pred and score.

    The language with the largest margin wins, the first by name among equals; the score is its
    share among the margins after a softmax, between 0 and 1. A null or empty text and one
    without any letter is ``und`` with score 0, as is every text if there was nothing to learn
    from. Whole texts are read whatever their length. Rows are independent of each other.
    """
    keep = list(df.columns if keep is None else keep)
    letter = "_has_letter"
    src = df.withColumn(letter, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def work(column, letters):
            texts, ok = raw(column), letters.to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            todo = [i for i, yes in enumerate(ok) if yes] if m else []
            for s in range(0, len(todo), ROWS):
                part = todo[s : s + ROWS]
                margin = m.margins(unit_rows([texts[i] for i in part])).astype(np.float64)
                e = np.exp(4 * (margin - margin.max(1, keepdims=True)))
                best = margin.argmax(1)
                share = e[np.arange(len(part)), best] / e.sum(1)
                for i, k, v in zip(part, best, share, strict=True):
                    names[i], scores[i] = m.langs[k], float(v)
            return [names, scores]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return add_columns(src, fields, make, [text, letter], keep)
