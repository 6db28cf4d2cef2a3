"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleflow.session import settle


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one batch reduced to links between each node and the smallest of its local group."""
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent[p]
                x = parent[x]
            return x

        for x, y in zip(a, b, strict=True):
            if (r := root(x)) != (s := root(y)):
                parent[max(r, s)] = min(r, s)
        nodes = [x for x in list(parent) if root(x) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(nodes, np.int64)), pa.array(np.array([root(x) for x in nodes], np.int64))], names=["a", "b"]
        )


def _star(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links a > b."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (two long columns, undirected) that is not
    the smallest of its component; ``root`` is that smallest node.

    Each round is written to the shared folder, so lineage stays short. The number of rounds
    grows with the logarithm of the longest path. No links give no rows; repeated links and
    links of a node to itself count once or not at all.
    """
    a, b = (F.col(c) for c in links.columns)
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    now = settle(links.mapInArrow(_forest, "a long, b long").distinct(), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if tuple(seen) == mark or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)
        now = settle(_star(now), "links")
