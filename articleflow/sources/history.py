"""The history with an index of its keys and verdicts laid over it.

A load publishes its rows and the keys of its rows in one commit. The index has a row for each key
with the load that stored it, partitioned by a hash prefix, so a lookup reads the prefixes of its batch and
not the history: what a load costs follows the load, however long the history has become.
Verdicts are stored as small batches of changes and laid over the loads when these are read; compaction
writes them into the loads they touch. Every step is one commit, so a repeated step changes
nothing and a broken one is not seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.functions.text import strip, text_of
from articleflow.operators.incremental import PREFIX, align_columns, key_prefix, spread_join
from articleflow.schema import EVALUATED, VERDICT_FIELDS
from articleflow.sources import snapshots
from articleflow.sources.tables import HISTORY, LOADS

KEYS = ("uid", "url")
DELTA = T.StructType([T.StructField(c, T.StringType()) for c in ("uid", *VERDICT_FIELDS)] + [T.StructField("delta", T.LongType())])


def index_schema(by: str) -> T.StructType:
    return T.StructType(
        [T.StructField(by, T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("load_id", T.LongType()), T.StructField(PREFIX, T.IntegerType())]
    )


def _load(run_id: str, load_id: int) -> str:
    return f"{run_id}/{load_id}"


def _index_rows(rows: DataFrame, by: str) -> DataFrame:
    """The keys of stored rows; a row without a key has none. A key that fills a load is one row."""
    key = strip(text_of(F.col(by)))
    keyed = rows.select(key.alias(by), "run_id", "load_id").filter(F.col(by) != "").distinct()
    return keyed.withColumn(PREFIX, key_prefix(F.col(by)))


def _stage_index(rows: DataFrame, path: str, by: str) -> str:
    # One file for each prefix, sorted, so that a lookup can skip parts of it.
    dealt = _index_rows(rows, by).repartition(PREFIX).sortWithinPartitions(PREFIX, by)
    return snapshots.stage(dealt, path, f"index_{by}", [PREFIX])


def write_load(rows: DataFrame, path: str, load_id: int, run_id: str = LOADS) -> int:
    """Publish one load and its keys together; publishing it again replaces both, also by nothing.

    Columns are aligned with the history's. The keys are taken from what was written, so ``rows`` is evaluated once.
    """
    spark = rows.sparkSession
    stored = align_columns(rows).withColumns({"run_id": F.lit(run_id), "load_id": F.lit(load_id).cast("long")})
    folder = snapshots.stage(stored, path, "loads")
    written = spark.read.schema(HISTORY).parquet(f"{path}/data/loads/{snapshots.COMMIT}={folder}")
    name = _load(run_id, load_id)
    slots: dict[str, str | None] = {f"loads/{name}": folder}
    slots |= {f"index_{by}/{name}": _stage_index(written, path, by) for by in KEYS}
    return snapshots.commit(spark, path, slots)


BASE = "base"


def read_index(spark: SparkSession, path: str, by: str = "uid") -> DataFrame:
    """Rows (key, run_id, load_id) of all loads. It stands for the history wherever keys are looked up
    (``new_rows``, ``not_in_history``, ``load_batch`` with ``stored=True``).

    A load that was published again since the index was merged counts by its own keys only.
    """
    kind = f"index_{by}"
    found = snapshots.live(spark, path, f"{kind}/")
    schema = index_schema(by)
    rows = snapshots.read(spark, path, kind, T.StructType([*schema.fields, T.StructField(snapshots.COMMIT, T.StringType())]), list(found))
    later = [s.removeprefix(f"{kind}/") for s in found if s != f"{kind}/{BASE}"]
    if later and f"{kind}/{BASE}" in found:
        name = F.concat("run_id", F.lit("/"), F.col("load_id").cast("string"))
        rows = rows.filter((F.col(snapshots.COMMIT) != found[f"{kind}/{BASE}"]) | ~name.isin(later))
    return rows.select(*schema.fieldNames())


def read_loads(spark: SparkSession, path: str, run_id: str | None = None, load_ids: list[int] | None = None) -> DataFrame:
    """The loads as they were written, without verdicts laid over them."""
    slots = None if load_ids is None else [f"loads/{_load(run_id or LOADS, i)}" for i in load_ids]
    return snapshots.read(spark, path, "loads", HISTORY, slots, "" if run_id is None else f"{run_id}/")


def _publish_index(spark: SparkSession, path: str, read: Callable[[str], DataFrame]) -> int:
    """Replace the index slots there are by one; loads written meanwhile keep their own."""
    slots: dict[str, str | None] = {}
    for by in KEYS:
        slots |= dict.fromkeys(snapshots.live(spark, path, f"index_{by}/"))
        slots[f"index_{by}/{BASE}"] = _stage_index(read(by), path, by)
    return snapshots.commit(spark, path, slots)


def rebuild_index(spark: SparkSession, path: str) -> int:
    """Make the index anew from the loads, in one commit."""
    return _publish_index(spark, path, lambda by: read_loads(spark, path))


def compact_index(spark: SparkSession, path: str) -> int:
    """Merge the index of all loads into one slot, so that a prefix is one file again."""
    return _publish_index(spark, path, lambda by: read_index(spark, path, by))


def write_verdicts(batch: DataFrame, path: str, delta: int, pos: str) -> int:
    """Publish the verdicts of one batch; the last row of a uid counts, and publishing it again replaces it.

    ``delta`` numbers the batches in the order they are to be applied. A null verdict leaves what was there;
    rows without a uid have nothing to meet.
    """
    named = batch.filter(text_of(F.col("uid")) != "")
    last = named.groupBy("uid").agg(F.max_by(F.struct(*VERDICT_FIELDS), F.col(pos)).alias("v"))
    rows = last.select("uid", *(F.col("v")[c].cast("string").alias(c) for c in VERDICT_FIELDS), F.lit(delta).cast("long").alias("delta"))
    return snapshots.publish(rows, path, f"verdicts/{delta:020d}")


def _newest(deltas: DataFrame) -> DataFrame:
    """One row for each uid: of each column the last value that is there."""

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("delta"))).alias(f"_{c}")

    return deltas.groupBy("uid").agg(*(last(c) for c in VERDICT_FIELDS))


def overlay(loads: DataFrame, deltas: DataFrame) -> DataFrame:
    """Rows of the loads with the newest verdicts of their uid."""
    joined = spread_join(loads, _newest(deltas), ["uid"], "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in VERDICT_FIELDS}).select(*loads.columns)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history: all loads with the stored verdicts laid over them."""
    loads = read_loads(spark, path)
    if not snapshots.live(spark, path, "verdicts/"):
        return loads
    return overlay(loads, snapshots.read(spark, path, "verdicts", DELTA))


def compact_verdicts(spark: SparkSession, path: str) -> int:
    """Write stored verdicts into the loads they touch and drop them, in one commit.

    The index says which loads hold a judged uid; others are neither read nor written. Verdicts
    published meanwhile stay. Rows that readers see don't change.
    """
    taken = snapshots.live(spark, path, "verdicts/")
    if not taken:
        return snapshots.version(spark, path)
    deltas = snapshots.read(spark, path, "verdicts", DELTA, list(taken))
    judged = deltas.select("uid").distinct()
    wanted = judged.withColumn(PREFIX, key_prefix(F.col("uid"))).filter(F.col("uid") != "")
    touched = read_index(spark, path).join(wanted, [PREFIX, "uid"], "left_semi").select("run_id", "load_id").distinct().collect()
    slots: dict[str, str | None] = dict.fromkeys(taken)
    for r in touched:
        load = read_loads(spark, path, r.run_id, [r.load_id])
        slots[f"loads/{_load(r.run_id, r.load_id)}"] = snapshots.stage(overlay(load, deltas), path, "loads")
    return snapshots.commit(spark, path, slots)


def import_history(history: DataFrame, path: str, load_id: int = 0, run_id: str = "imported") -> int:
    """Take over rows of an older history as one load with its keys."""
    return write_load(history.select(*(c for c in EVALUATED.fieldNames() if c in history.columns)), path, load_id, run_id)


def drop_load(spark: SparkSession, path: str, load_id: int, run_id: str = LOADS) -> int:
    """Take a load and its keys out of the history, in one commit."""
    name = _load(run_id, load_id)
    slots: dict[str, str | None] = {f"loads/{name}": None}
    # Keys of the load that were merged are hidden by its own, empty ones.
    slots |= {f"index_{by}/{name}": snapshots.stage(spark.createDataFrame([], index_schema(by)), path, f"index_{by}", [PREFIX]) for by in KEYS}
    return snapshots.commit(spark, path, slots)
