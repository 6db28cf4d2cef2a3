"""History, batch, evaluated and digest tables.

Each load of the history has a partition of its own, named by the run that wrote it and its
number in that run (``run_id``, ``load_id``), so runs that number their loads alike don't meet.
A repeated load replaces its own partition, also when it has no rows left, and a verdict
write-back rewrites only the partitions that hold rows of the batch. CSV and JSON outputs go
to a new path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.functions.text import text_of
from articleflow.operators.incremental import align_columns, apply_backfill, write_back
from articleflow.schema import EVALUATED, VERDICT_FIELDS
from articleflow.sources import snapshots

HISTORY = T.StructType([*EVALUATED.fields, T.StructField("run_id", T.StringType()), T.StructField("load_id", T.LongType())])
LOADS = "loads"  # the run of loads written without a stream


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history; columns a file lacks are null, so older layouts stay readable."""
    return spark.read.schema(HISTORY).parquet(path)


def create_history(spark: SparkSession, path: str) -> None:
    """An empty history where there is none yet."""
    try:
        read_history(spark, path)
        return
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    empty = spark.createDataFrame([], HISTORY)
    empty.write.mode("append").partitionBy("run_id", "load_id").parquet(path)


def _replace(rows: DataFrame, folder: str) -> None:
    """Make ``rows``, even none, the whole content of one partition's folder."""
    rows.write.mode("overwrite").parquet(folder)


def write_load(rows: DataFrame, path: str, load_id: int, run_id: str = LOADS) -> None:
    """Write one load; writing it again replaces it, also by nothing."""
    _replace(align_columns(rows), f"{path}/run_id={run_id}/load_id={load_id}")


def save_bucketed_history(history: DataFrame, table: str, path: str, buckets: int) -> None:
    """History bucketed by uid: the anti-join of a load then reads it without a shuffle."""
    (
        history.write.mode("overwrite").option("path", path)
        .bucketBy(buckets, "uid").sortBy("uid").saveAsTable(table)
    )


def write_batch(rows: DataFrame, path: str, run_date: str) -> None:
    """The new batch of a run date, replaced as a whole when the run is repeated."""
    _replace(align_columns(rows), f"{path}/run_date={run_date}")


def write_back_history(
    spark: SparkSession, path: str, batch: DataFrame, pos: str, load_ids: list[int] | None = None
) -> None:
    """Put verdicts into the stored history, rewriting the touched loads only.

    A run knows which loads it judged: with ``load_ids`` only their partitions are
    read. Otherwise the uid column of the history is searched for them first.
    """
    history = read_history(spark, path)
    if load_ids is not None:
        part = history.filter(F.col("load_id").isin(load_ids))
    else:
        judged = batch.select("uid").distinct()
        touched = history.join(judged, "uid", "left_semi").select("run_id", "load_id").distinct()
        part = history.join(touched, ["run_id", "load_id"], "left_semi")
    _rewrite(write_back(part, batch, pos, VERDICT_FIELDS), path)


def backfill_history(spark: SparkSession, path: str, updates: DataFrame, pos: str) -> None:
    """Fill gaps of the stored history from refetched rows, rewriting the touched loads only."""
    history = read_history(spark, path)
    gaps = history.filter((text_of(F.col("content")) == "") | (text_of(F.col("abstract")) == ""))
    touched = gaps.join(updates.select("url").distinct(), "url", "left_semi").select("run_id", "load_id").distinct()
    _rewrite(apply_backfill(history.join(touched, ["run_id", "load_id"], "left_semi"), updates, pos), path)


def _rewrite(rows: DataFrame, path: str) -> None:
    """Replace the loads that ``rows`` are the whole content of."""
    (
        rows.select(*[f.name for f in HISTORY.fields])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "load_id").parquet(path)
    )


def write_counted(rows: DataFrame, write: Callable[[DataFrame], object], /, **measures: Column) -> dict[str, int]:
    """``write(rows)``, and aggregates over the rows that pass by on the way: counting costs no
    second read of what the rows are made from. A failed write raises and counts nothing."""
    seen = Observation()
    write(rows.observe(seen, *(m.alias(n) for n, m in measures.items())))
    return seen.get


def write_evaluated(df: DataFrame, path: str) -> None:
    """Evaluated rows as JSON or CSV by the suffix of ``path``, else as Parquet."""
    if path.endswith(".json"):
        df.write.mode("errorifexists").json(path)
    elif path.endswith(".csv"):
        (
            df.write.mode("errorifexists").option("header", True).option("quoteAll", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("escape", '"').csv(path)
        )
    else:
        df.write.mode("errorifexists").parquet(path)


def read_evaluated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Evaluated rows as ``write_evaluated`` wrote them, by the suffix of ``path``; a missing text is empty."""
    reader = spark.read.schema(schema)
    if path.endswith(".json"):
        rows = reader.json(path)
    elif path.endswith(".csv"):
        rows = reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    else:
        rows = reader.parquet(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({c: text_of(F.col(c)) for c in texts})


def write_digest(lines: DataFrame, path: str, run_date: str) -> None:
    _replace(lines, f"{path}/run_date={run_date}")


# The same tables as snapshots: readers see a run date's former content until the new one is whole.
BATCH = T.StructType([*EVALUATED.fields, T.StructField("run_date", T.StringType())])
DIGEST = T.StructType([T.StructField("item_no", T.LongType()), T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType()), T.StructField("run_date", T.StringType())])


def publish_batch(rows: DataFrame, path: str, run_date: str) -> int:
    """The new batch of a run date, replaced as a whole when the run is repeated, also by nothing."""
    return snapshots.publish(align_columns(rows).withColumn("run_date", F.lit(run_date)), path, f"batch/{run_date}")


def read_batches(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    return snapshots.read(spark, path, "batch", BATCH, None if run_date is None else [f"batch/{run_date}"])


def publish_digest(lines: DataFrame, path: str, run_date: str) -> int:
    """The digest lines of a run date, replaced as a whole."""
    rows = lines.select(F.col("item_no").cast("long"), F.col("line_no").cast("long"), "line", F.lit(run_date).alias("run_date"))
    return snapshots.publish(rows, path, f"digest/{run_date}")


def read_digest(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    return snapshots.read(spark, path, "digest", DIGEST, [f"digest/{run_date}"]).drop("run_date")
