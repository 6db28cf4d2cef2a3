"""SimHash fingerprints and their links by a self-join over a binary trie."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.llm.common import LOWER, add_columns, raw
from articleflow.llm.components import components
from articleflow.session import settle

SEED = 42
# A trie node with more fingerprints than this is split into pairs of deeper nodes.
NODE_ROWS = 50_000
# Levels by which a split goes deeper.
SPLIT_BITS = 8
# Pairs of nodes that one step of the traversal holds.
FRONTIER = 1_000_000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of word shingles; zero for a text without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda e, n: e + 1 + n))
    if len(words) <= shingle:
        parts = [line]
    else:
        starts = [0, *(e + 1 for e in ends[:-shingle])]
        parts = [line[s:e] for s, e in zip(starts, ends[shingle - 1 :], strict=True)]
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED))), np.uint8).reshape(-1, 8)
    ones = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """``df`` with its texts' fingerprints as a signed long; null and empty texts have zero."""

    def make():
        return lambda column: [[fingerprint(x, shingle) for x in raw(column)]]

    return add_columns(df, [T.StructField(out, T.LongType())], make, [text], keep)


def _turn(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def _blocks(parts: int) -> list[tuple[int, int]]:
    """Start and width of each part of 64 bits, from the highest bit."""
    cuts = [round(64 * i / parts) for i in range(parts + 1)]
    return [(s, e - s) for s, e in zip(cuts, cuts[1:], strict=False)]


def _pairs_below(rot: np.ndarray, starts: list[tuple[int, int, int, int]], first: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the error budget, from pairs of nodes given as ranges of ``rot``.

    Each step goes down one level in both nodes of every pair. A pair whose halves differ in
    that bit has one error more and is dropped beyond the budget. Pairs of single
    fingerprints are compared at once.
    """
    stack = [(first, np.array(starts, np.int64).reshape(-1, 4), np.zeros(len(starts), np.int8))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, nodes, err = stack.pop()
        if len(nodes) > FRONTIER:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half], err[:half]), (depth, nodes[half:], err[half:])]
            continue
        alo, ahi, blo, bhi = nodes.T
        same = alo == blo
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if (done := single & ~same).any():
            i, j = alo[done], blo[done]
            near = np.bitwise_count(rot[i] ^ rot[j]) <= bits
            yield i[near], j[near]
        nodes, err = nodes[~single], err[~single]
        if depth == 64 or not len(nodes):
            continue
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((rot >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)])
        alo, ahi, blo, bhi = nodes.T
        same = alo == blo
        amid = ahi - (ones[depth][ahi] - ones[depth][alo])
        bmid = bhi - (ones[depth][bhi] - ones[depth][blo])
        left = (np.stack([alo, amid, blo, bmid], 1), err)
        right = (np.stack([amid, ahi, bmid, bhi], 1), err)
        cross = (np.stack([alo, amid, bmid, bhi], 1), err + 1)
        back = (np.stack([amid, ahi, blo, bmid], 1)[~same], (err + 1)[~same])
        nodes = np.concatenate([x for x, _ in (left, right, cross, back)])
        err = np.concatenate([e for _, e in (left, right, cross, back)])
        live = (nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (err <= bits)
        stack.append((depth + 1, nodes[live], err[live]))


def _join_nodes(bits: int):
    blocks = _blocks(bits + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        block, depth, a, b, side, rot = (t.column(i).to_numpy() for i in range(6))
        rot = rot.view(np.uint64)
        order = np.lexsort((rot, side, b, a, depth, block))
        block, depth, a, b, side, rot = (x[order] for x in (block, depth, a, b, side, rot))
        change = np.flatnonzero((np.diff(block) != 0) | (np.diff(depth) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
        edges = np.concatenate([[0], change, [len(rot)]])
        starts = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if a[lo] == b[lo]:
                starts.append((lo, hi, lo, hi))
            else:
                mid = lo + int(np.searchsorted(side[lo:hi], 1))
                if lo < mid < hi:
                    starts.append((lo, mid, mid, hi))
        turn = np.array([s for s, _ in blocks], np.uint64)[block]
        own = np.where(turn == 0, rot, (rot >> turn) | (rot << ((np.uint64(64) - turn) & np.uint64(63))))
        for i, j in _pairs_below(rot, starts, min(w for _, w in blocks), bits):
            x, y = own[i], own[j]
            first = np.ones(len(i), bool)
            for k, (s, w) in enumerate(blocks):  # a pair that agrees in an earlier part is found there
                mask = np.uint64(((1 << w) - 1) << (64 - s - w))
                first &= ~((block[i] > k) & (((x ^ y) & mask) == 0))
            yield pa.RecordBatch.from_arrays([pa.array(x[first].view(np.int64)), pa.array(y[first].view(np.int64))], names=["a", "b"])

    return run


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``bits`` bits, each once.

    Two such values agree in one of ``bits + 1`` parts at least. For each part the values are
    turned so that it leads; values that agree in it stand below one trie node, and the nodes
    are joined with themselves in separate tasks. A node with very many values is first replaced
    by the pairs of its descendants that are still within the budget, again until none is
    large. A value has a bounded number of neighbours, so the result grows with the values.
    """
    fp = fps.columns[0]
    views = []
    for k, (start, width) in enumerate(_blocks(bits + 1)):
        rot = _turn(F.col(fp), start)
        lead = F.shiftrightunsigned(rot, 64 - width)
        views.append(fps.select(F.lit(k).alias("block"), F.lit(width).alias("depth"), lead.alias("a"), lead.alias("b"), F.lit(0).alias("side"), rot.alias("rot")))
    nodes = reduce(DataFrame.union, views)
    keys = ["block", "depth", "a", "b"]
    masks = [m for m in range(1 << SPLIT_BITS) if bin(m).count("1") <= bits]
    while True:
        large = nodes.groupBy(*keys).count().where((F.col("count") > NODE_ROWS) & (F.col("depth") + SPLIT_BITS <= 64)).drop("count")
        large = settle(large, "nodes")
        if not large.take(1):
            break
        cold = nodes.join(large, keys, "left_anti")
        hot = nodes.join(large, keys, "left_semi")
        deep = F.col("depth") + SPLIT_BITS
        own = F.expr(f"shiftrightunsigned(rot, 64 - depth - {SPLIT_BITS})")
        other = F.expr(f"shiftleft(if(side = 0, b, a), {SPLIT_BITS})").bitwiseOR(own.bitwiseAND(F.lit((1 << SPLIT_BITS) - 1))).bitwiseXOR(F.col("mask"))
        twin = F.col("a") == F.col("b")  # a node joined with itself: the smaller descendant comes first
        low = F.when(twin, F.least("own", "other")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
        high = F.when(twin, F.greatest("own", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
        side = F.when(twin, (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side"))
        parts = hot.withColumn("mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks)))).select("*", own.alias("own"), other.alias("other"))
        parts = parts.where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= bits)
        parts = parts.select("block", deep.alias("depth"), low.alias("a"), high.alias("b"), side.alias("side"), "rot")
        nodes = settle(cold.select(*parts.columns).union(parts), "nodes")
    return nodes.repartition(*keys).mapInArrow(_join_nodes(bits), "a long, b long")


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, bits: int = 2) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of ``df``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest id reachable
    over links of at most ``bits`` differing bits, the row's own included. Equal fingerprints
    are joined as one value, so copies are never paired. Texts that are null, empty or without
    words have fingerprint zero and link like any other. A missing id is never a
    ``component_id`` unless its whole component has none. Repeated rows give repeated rows; an
    empty table gives none; further columns are ignored.
    """
    rows = fingerprints(df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), keep=["id"], shingle=shingle)
    rows = settle(rows, "fingerprints")
    values = rows.groupBy("fp").agg(F.min("id").alias("least"))
    groups = components(links(values.select("fp"), bits))
    inner = values.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    roots = inner.groupBy("root").agg(F.min("least").alias("component_id"))
    named = inner.join(roots, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
