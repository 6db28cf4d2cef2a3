"""Vector code compression: product quantisation with exact rounds and norm-of-sum bounds.

Vectors become whole numbers and are cut into parts; each part has a codebook, refined by rounds
that assign every part to its nearest entry and move each entry to the floored mean of its
parts. All sums are sums of whole numbers, so results don't depend on how rows are dealt out.

A row keeps, for each part, its entry, an upper bound of the distance to it and a lower bound of the
distance to any other entry, each with the round it was measured in. All former codebooks
are kept, so a bound is carried on by the true distance between an entry's place then and now,
which is at most the sum of its moves. Only where the bounds overlap is the distance to the own entry
measured again, and only where they still overlap all entries are searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Up to here squared distances are exact in double precision; larger numbers are Python's.
EXACT = 1 << 22
# Slack of the bounds: far above the error of a square root, far below what parts two distances.
SLACK = 1e-6


def state_type(parts: int) -> np.dtype:
    """What a row keeps from round to round."""
    return np.dtype([("near", "<i4", parts), ("upper", "<f8", parts), ("upper_at", "u1", parts), ("lower", "<f8", parts), ("lower_at", "u1", parts)])


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact whole numbers."""
    if max(abs(x).max(initial=0), abs(entries).max(initial=0)) < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    a, b = x.astype(object), entries.astype(object)
    return np.array([((b - row) ** 2).sum(1) for row in a], object).reshape(len(a), len(b))


def own_squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the entry beside it."""
    kind = np.float64 if max(abs(x).max(initial=0), abs(entries).max(initial=0)) < EXACT else object
    gap = x.astype(kind) - entries.astype(kind)
    return (gap * gap).sum(1)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Bounds:
    """The newest codebooks and how far each entry has gone, net, since each former round."""

    def __init__(self, history: list[np.ndarray]):
        self.books = history[-1]
        self.now = len(history) - 1
        moved = np.stack([np.stack([_root(own_squared(p, q)) for p, q in zip(self.books, old, strict=True)]) for old in history], axis=1)
        self.moved = moved  # part, round, entry
        order = np.argsort(moved, axis=2)
        self.farthest = order[:, :, -1]
        self.most = np.take_along_axis(moved, order[:, :, -1:], 2)[:, :, 0]
        self.second = np.take_along_axis(moved, order[:, :, -2:-1], 2)[:, :, 0] if moved.shape[2] > 1 else np.zeros_like(self.most)

    def others(self, part: int, since: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The farthest that any entry but the own one has gone."""
        return np.where(self.farthest[part, since] == own, self.second[part, since], self.most[part, since])

    def assign(self, vectors: np.ndarray, state: np.ndarray | None) -> tuple[np.ndarray, int]:
        """The new state of rows (n, parts, width), and how many searches over all entries it took."""
        n, parts = vectors.shape[:2]
        out = np.zeros(n, state_type(parts)) if state is None else state.copy()
        searched = 0
        for p in range(parts):
            left = np.arange(n)
            if state is not None:
                near, lower_at = out["near"][:, p], out["lower_at"][:, p]
                upper = out["upper"][:, p] + self.moved[p, out["upper_at"][:, p], near]
                lower = out["lower"][:, p] - self.others(p, lower_at, near)
                left = left[~(upper + SLACK < lower)]
                exact = _root(own_squared(vectors[left, p], self.books[p][near[left]]))
                out["upper"][left, p], out["upper_at"][left, p] = exact, self.now
                left = left[~(exact + SLACK < lower[left])]
            searched += len(left)
            if len(left):
                found = squared(vectors[left, p], self.books[p])
                near = found.argmin(1)
                out["near"][left, p] = near
                out["upper"][left, p] = _root(found[np.arange(len(left)), near])
                out["lower"][left, p] = _root(np.partition(found, 1, 1)[:, 1]) if found.shape[1] > 1 else np.inf
                out["upper_at"][left, p] = out["lower_at"][left, p] = self.now
        return out, searched


def _whole(column: pa.Array, parts: int, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), parts, width)


def _round(history: list[np.ndarray], first: bool):
    """Assign the rows of a task; after them come its sums for each entry in use."""
    parts, entries, width = history[0].shape
    kind = state_type(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(history)
        sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        names = None
        for batch in batches:
            names = [*batch.schema.names[:3], "state", "entry", "n", "total"]
            vectors = _whole(batch.column(2), parts, width)
            state = None if first else np.frombuffer(b"".join(batch.column(3).to_pylist()), kind)
            state, _ = bounds.assign(vectors, state)
            for p in range(parts):
                near = state["near"][:, p]
                counts[p] += np.bincount(near, minlength=entries)
                order = np.argsort(near, kind="stable")
                used, starts = np.unique(near[order], return_index=True)
                if width and len(used):
                    sums[p, used] += np.add.reduceat(vectors[order, p], starts, axis=0)
            nothing = [pa.nulls(len(batch), t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            packed = pa.array([s.tobytes() for s in state], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed, *nothing], names=names)
            types = [c.type for c in batch.columns[:3]]
        if names is not None:
            used = np.flatnonzero(counts)
            blank = [pa.nulls(len(used), t) for t in types]
            totals = pa.array([[int(v) for v in sums.reshape(parts * entries, width)[e]] for e in used], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.nulls(len(used), pa.binary()), pa.array(used, pa.int32()), pa.array(counts.reshape(-1)[used], pa.int64()), totals], names=names
            )

    return run


def _final(history: list[np.ndarray], first: bool):
    parts, _, width = history[0].shape
    kind = state_type(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(history)
        for batch in batches:
            vectors = _whole(batch.column(2), parts, width)
            state, _ = bounds.assign(vectors, None if first else np.frombuffer(b"".join(batch.column(3).to_pylist()), kind))
            near = state["near"]
            error = sum(own_squared(vectors[:, p], bounds.books[p][near[:, p]]) for p in range(parts))
            codes = pa.array([row.tolist() for row in near], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], codes, pa.array([int(e) for e in error], pa.int64())], names=[*batch.schema.names[:2], "codes", "error"])

    return run


def whole_vectors(df: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows whose ``vector`` is there and has finite components only, as whole numbers (``ints``)."""
    x = F.col(vector)
    sound = x.isNotNull() & ~F.exists(F.coalesce(x, F.array()), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(sound).withColumn("ints", F.transform(x, lambda v: F.floor(v.cast("double") * scale)))


def compress(
    df: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, codes, error) and the codebooks (parts, entries, width).

    Rows without a vector, or with a null or non-finite component, are dropped. The codebooks
    begin as the vectors of the smallest ids (null ids last, equal ids by vector); fewer rows make smaller
    ones. Ties go to the lower index, an entry without any part stays. Rows with a vector
    of another length than the first kept one have null codes and error. Repeated rows and ids
    all count. An empty table gives no rows and empty codebooks. Other columns are dropped, so their names
    don't matter. Sums beyond 63 bits raise an error.

    A round is one pass: what a row keeps travels with it in a table in the shared folder, followed by the sums of
    its task, so nothing but the sums (one row for an entry) is shuffled or collected.
    """
    spark = df.sparkSession
    rows = whole_vectors(df.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")), "vector", scale).select("id", "label", "ints")
    now = settle(rows, "vectors")
    start = [r.ints for r in now.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()]
    names = f"id {df.schema[vec_id].dataType.simpleString()}, label {df.schema[label].dataType.simpleString()}"
    done = f"{names}, codes array<int>, error long"
    length = len(start[0]) if start else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    start = [v for v in start if len(v) == length]
    if not start:
        return spark.createDataFrame([], done).withColumnsRenamed({"id": vec_id, "label": label}), np.zeros((parts, 0, 0), np.int64)
    width = length // parts
    history = [np.array(start, np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)]
    other = now.where(F.size("ints") != length).select("id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"))
    now = now.where(F.size("ints") == length)
    first = True
    for _ in range(rounds):
        columns = ["id", "label", "ints"] if first else ["id", "label", "ints", "state"]
        made = settle(now.select(*columns).mapInArrow(_round(history, first), f"{names}, ints array<long>, state binary, entry int, n long, total array<long>"), "round")
        books = history[-1].copy()
        sums = made.where("entry is not null").groupBy("entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(width)))
        for r in sums.collect():
            books[divmod(r.entry, len(start))] = [r[f"s{i}"] // r.n for i in range(width)]
        history.append(books)
        now, first = made.where("entry is null"), False
    columns = ["id", "label", "ints"] if first else ["id", "label", "ints", "state"]
    coded = now.select(*columns).mapInArrow(_final(history, first), done)
    return coded.unionByName(other).withColumnsRenamed({"id": vec_id, "label": label}), history[-1]


def decompress(coded: DataFrame, books: np.ndarray, codes: str = "codes", name: str = "ints") -> DataFrame:
    """``coded`` with the whole-number vector that its codes stand for (null for null codes)."""
    if not books.size:
        return coded.withColumn(name, F.when(F.col(codes).isNotNull(), F.array().cast("array<long>")))
    tables: list[Column] = [F.array(*(F.array(*(F.lit(int(v)) for v in entry)) for entry in part)) for part in books]
    return coded.withColumn(name, F.when(F.col(codes).isNotNull(), F.concat(*(F.get(t, F.get(codes, F.lit(p))) for p, t in enumerate(tables)))).cast("array<long>"))


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, as decimals with commas between."""
    return hashlib.sha256(",".join(str(v) for v in books.reshape(-1).tolist()).encode()).hexdigest()
