"""Toxic passages as maximum-scoring segments of token log-odds.

Each token's log-odds between toxic and other labelled documents is shrunk by a Dirichlet prior
that follows the token's share in both. Tokens well above their error score positive, all others a
small negative value, and a linear scan finds every maximal segment. Extreme-value statistics of
the non-toxic documents turn segment scores into bits, and a small regression turns a document's
bits into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.llm.common import add_columns, raw
from articleflow.llm.decontaminate import spans_of, words_of
from articleflow.llm.logistic import Logistic, platt, sigmoid
from articleflow.llm.quality import sample
from articleflow.session import settle

# Bound of the fit: labelled rows of each label.
PER_LABEL = 6000
# Weight of the prior, as a share of all counted tokens; least z-score of a scoring token.
PRIOR = 0.1
MIN_Z = 3.0
# A word also counts by its first bytes, for compounds that were not seen.
STEM = 6
# Expected false segments in one text below which a segment is reported.
MAX_EXPECTED = 0.05
MEMO = 300_000


def units(words: list[bytes]) -> set[bytes]:
    """Distinct words and stems of a text."""
    found = set(words)
    found |= {w[:STEM] + b"*" for w in list(found) if len(w) > STEM}
    return found


class Scores(dict):
    """Positive score of a word, or 0; remembers a bounded number of words."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> float:
        s = self.lexicon.get(word)
        if s is None:
            s = self.lexicon.get(word[:STEM] + b"*", 0.0) if len(word) > STEM else 0.0
        if len(self) >= MEMO:
            self.clear()
        self[word] = s
        return s


def segments(at: list[int], scores: list[float], gap: float) -> list[tuple[int, int, float]]:
    """All maximal segments (first, last, score) of a sequence in which the positions ``at`` have
    ``scores`` above zero and every other position ``-gap``; one pass over the positions."""
    out: list[tuple[int, int, float, float]] = []  # first, last, sums before and after
    total, before = 0.0, -1
    for i, s in zip(at, scores, strict=True):
        total -= gap * (i - before - 1)
        before = i
        first, left, right = i, total, total + s
        total = right
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= left:
                j -= 1
            if j < 0 or out[j][3] >= right:
                out.append((first, i, left, right))
                break
            first, left = out[j][0], out[j][2]
            del out[j:]
            j = len(out) - 1
    return [(a, b, right - left) for a, b, left, right in out]


@dataclass
class Model:
    lexicon: dict[bytes, float]
    gap: float
    rate: float  # lambda of the extreme-value law
    scale: float  # K
    logistic: Logistic

    def find(self, words: list[bytes], memo: Scores) -> list[tuple[int, int, float]]:
        scored = [(i, s) for i, s in enumerate(map(memo.__getitem__, words)) if s > 0]
        return segments([i for i, _ in scored], [s for _, s in scored], self.gap)

    def bits(self, score: float, n: int) -> float:
        """Minus log2 of the expected number of segments of this score among n non-toxic words."""
        return (self.rate * score - np.log(self.scale * max(n, 1))) / np.log(2)

    def features(self, found: list[tuple[int, int, float]], n: int) -> tuple[float, float, float]:
        bits = [self.bits(s, n) for _, _, s in found]
        low = -np.log2(self.scale * max(n, 1))
        good = [b for b in bits if b >= -np.log2(MAX_EXPECTED)]
        return max([low, *bits]), sum(good), float(np.log1p(sum(s for _, _, s in found)))


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for t, y in zip(raw(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            counts[y].update(units(words_of(t)))
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([counts[0][w] for w in names], pa.int64()), pa.array([counts[1][w] for w in names], pa.int64())],
            names=["unit", "clean", "toxic"],
        )


def lexicon(rows: DataFrame) -> tuple[dict[bytes, float], float]:
    """Scoring tokens of labelled rows (text, y) and the share of such tokens in toxic texts.

    A token counts once for each document, so that a repetitive text has no more weight than
    another. The counts are added up in Spark; only tokens above MIN_Z reach the driver.
    """
    counts = rows.select("text", "y").mapInArrow(_unit_counts, "unit binary, clean long, toxic long")
    counts = settle(counts.groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "units")
    n0, n1 = counts.agg(F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n0 or not n1:
        return {}, 0.0
    prior, n = PRIOR * (n0 + n1), n0 + n1
    a = F.lit(prior / n) * (F.col("clean") + F.col("toxic"))
    y1, y0 = F.col("toxic") + a, F.col("clean") + a
    odds = F.log(y1 / (n1 + prior - y1)) - F.log(y0 / (n0 + prior - y0))
    scored = counts.select("unit", "toxic", odds.alias("odds"), (odds / F.sqrt(1 / y1 + 1 / y0)).alias("z")).where(F.col("z") >= MIN_Z)
    got = scored.collect()
    return {bytes(r.unit): float(r.odds) for r in got}, sum(r.toxic for r in got) / n1


def _law(score: np.ndarray, n: np.ndarray, values: dict[float, int], gap: float, words: float) -> tuple[float, float]:
    """Rate and scale of the extreme-value law of the best segment among non-toxic texts, from the
    counts of their positive token scores.

    The rate solves E[exp(rate * token score)] = 1 over their tokens; the scale makes the
    expected number of texts with any segment equal to the observed one.
    """
    if not values:
        return 1.0, 1e-3
    v, times = np.array(list(values)), np.array(list(values.values()), float)

    def excess(rate: float) -> float:
        return ((times * np.exp(rate * v)).sum() + (words - times.sum()) * np.exp(-rate * gap)) / words - 1

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    rate = max(low, 0.05)
    floor, seen = float(v.min()), float((score > 0).sum())
    a, b = 1e-12, 1e6
    for _ in range(100):
        mid = np.sqrt(a * b)
        a, b = (mid, b) if (1 - np.exp(-mid * n * np.exp(-rate * floor))).sum() < seen else (a, mid)
    return rate, float(np.sqrt(a * b))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", per_label: int = PER_LABEL) -> Model:
    """Model from at most ``per_label`` labelled rows of each label."""
    rows = sample(docs, labels, text, doc_id, label, per_label)
    rows = settle(rows.select("text", "y", "h"), "labelled")
    words, share = lexicon(rows)
    gap = max(2 * share, 1e-3)
    draft = Model(words, gap, 1.0, 1.0, Logistic(np.zeros(3), 0.0))
    shared = docs.sparkSession.sparkContext.broadcast(draft)

    def make():
        m = shared.value
        memo = Scores(m.lexicon)

        def work(column):
            out = []
            for t in raw(column):
                w = words_of(t)
                hits = Counter(s for s in map(memo.__getitem__, w) if s > 0)
                out.append((len(w), [s for _, _, s in m.find(w, memo)], list(hits), list(hits.values())))
            return list(zip(*out, strict=True)) if out else [[], [], [], []]

        return work

    reals = T.ArrayType(T.DoubleType())
    fields = [T.StructField("n", T.LongType()), T.StructField("found", reals), T.StructField("hits", reals), T.StructField("times", T.ArrayType(T.LongType()))]
    got = add_columns(rows, fields, make, ["text"], ["h", "y"]).orderBy("h", "y", "n").limit(2 * per_label).collect()
    clean = [r for r in got if r.y == 0]
    best = np.array([max(r.found, default=0.0) for r in clean])
    n = np.array([max(r.n, 1) for r in clean], float)
    values: Counter[float] = Counter()
    for r in clean:
        values.update(dict(zip(r.hits, r.times, strict=True)))
    rate, scale = _law(best, n, values, gap, float(n.sum()) if len(n) else 1.0)
    model = Model(words, gap, rate, scale, Logistic(np.zeros(3), 0.0))
    y = np.array([r.y for r in got], float)
    x = np.array([model.features([(0, 0, s) for s in r.found], r.n) for r in got]).reshape(-1, 3)
    model.logistic = _regress(x, y)
    return model


def _regress(x: np.ndarray, y: np.ndarray, steps: int = 100) -> Logistic:
    """Logistic regression on a few columns by Newton's method, then calibrated."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Logistic(np.zeros(3), float(np.log(share / (1 - share))))
    mean, dev = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([(x - mean) / dev, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(z @ w)
        h = z.T @ (z * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (p - y) + w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    model = Logistic(w[:-1] / dev, float(w[-1] - (w[:-1] * mean / dev).sum()))
    model.slope, model.shift = platt(x @ model.weights + model.bias, y)
    return model


_PASSAGE = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("bits", T.DoubleType())]))


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with score, predicted and toxic_passages (characters of the text, and bits).

    Null and empty texts have no segment and get the score of a text without toxic tokens. Whole
    texts are scanned in linear time; rows are independent. Without labels of both kinds every
    text has the smoothed share of label 1.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        memo = Scores(m.lexicon)

        def work(column):
            probabilities, passages = [], []
            for t in raw(column):
                w = words_of(t)
                found = m.find(w, memo)
                x = np.array(m.features(found, len(w)))
                probabilities.append(float(m.logistic.probability(x @ m.logistic.weights + m.logistic.bias)))
                good = [(a, b, m.bits(s, len(w))) for a, b, s in found]
                good = [g for g in good if g[2] >= -np.log2(MAX_EXPECTED)]
                places = spans_of(t, [(a, b) for a, b, _ in good])
                passages.append([{"start": s, "end": e, "bits": float(g[2])} for (s, e), g in zip(places, good, strict=True)])
            return [probabilities, [int(p >= 0.5) for p in probabilities], passages]

        return work

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("toxic_passages", _PASSAGE)]
    return add_columns(df, fields, make, [text], keep)
