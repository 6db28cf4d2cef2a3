"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A batch is a set of signed changes: an insert adds a document and its tokens, a delete takes both
back, a revised count adds the difference. Each batch is summed before it is stored, as a slot of a snapshot table
named by its number; committing it again replaces that slot, so a replay changes nothing, and a commit that
dies is not seen. Totals are the sums over the running total and the batches since; ``compact`` moves
batches into the running total in one commit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.sources import snapshots

KEYS = ["source", "lang", "version"]
STORED = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS] + [T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("batch", T.LongType())]
)
# Tokenizer versions: words between ASCII blanks; runs of letters and digits, and single other signs.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"}


def counted(text: Column, version: str) -> Column:
    """Tokens of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def _changes(df: DataFrame, counts: dict[str, Column], docs: int) -> DataFrame:
    each = F.explode(F.array(*(F.struct(F.lit(v).alias("version"), n.alias("tokens")) for v, n in counts.items())))
    return df.select(F.col("source").cast("string"), F.col("lang").cast("string"), each.alias("x")).select(
        "source", "lang", "x.version", F.lit(docs).cast("long").alias("docs"), F.col("x.tokens").cast("long").alias("tokens")
    )


def inserts(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """A change for each row and version; ``counts`` gives the tokens of a row by version."""
    return _changes(df, counts, 1)


def deletes(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    return _changes(df, {v: -n for v, n in counts.items()}, -1)


def revisions(df: DataFrame, before: dict[str, Column], after: dict[str, Column]) -> DataFrame:
    return _changes(df, {v: after[v] - before[v] for v in before}, 0)


def commit(changes: DataFrame | list[DataFrame], root: str, batch: int) -> None:
    """Store one batch, summed by KEYS. An empty batch is stored as such; a source or language
    that is null is a group of its own. The keys are few, so what is stored does not grow with
    the batch, and the sums are taken before the shuffle, whatever source is hot. A batch that the running
    total holds already stays as it is."""
    parts = changes if isinstance(changes, list) else [changes]
    spark = parts[0].sparkSession
    if batch <= _merged(spark, root):
        return
    rows = reduce(DataFrame.union, [p.select(*KEYS, "docs", "tokens") for p in parts])
    sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    snapshots.publish(sums.withColumn("batch", F.lit(batch).cast("long")), root, f"totals/batch/{batch:012d}")


def _merged(spark: SparkSession, root: str) -> int:
    """The last batch in the running total; -1 if there is none."""
    found = [int(s.rsplit("/", 1)[1]) for s in snapshots.live(spark, root, "totals/running/")]
    return max(found, default=-1)


def compact(spark: SparkSession, root: str, upto: int) -> None:
    """Move the batches up to number ``upto`` into the running total. Totals don't change; from then on
    these batches are settled, and totals before ``upto`` can't be asked for any more."""
    live = snapshots.live(spark, root, "totals/")
    taken = [s for s in live if int(s.rsplit("/", 1)[1]) <= upto]
    if not taken:
        return
    rows = snapshots.read(spark, root, "totals", STORED, taken)
    sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
    folder = snapshots.stage(sums.withColumn("batch", F.lit(upto).cast("long")), root, "totals")
    snapshots.commit(spark, root, {**dict.fromkeys(taken), f"totals/running/{upto:012d}": folder})


def totals(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Sums over all committed batches, or those numbered up to ``upto``; groups with no document
    and no token left are not listed."""
    if upto is not None and upto < _merged(spark, root):
        raise ValueError(f"the running total holds batches after {upto}")
    rows = snapshots.read(spark, root, "totals", STORED)
    if upto is not None:
        rows = rows.where(F.col("batch") <= upto)
    sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
    return sums.where("n_docs <> 0 or n_tokens <> 0")
