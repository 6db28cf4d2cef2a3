"""Tables published by a log: what is written is seen as a whole, or not at all.

A table is a folder. ``data/<kind>/commit=<id>`` holds what one write put there and is never changed;
``log`` has a row for each slot that a commit sets or removes. A slot is what is replaced as a
whole, such as a load or a run date, and is named ``kind/name``. The commit is the appearance of one small file in the
log, so a write that dies, before or during it, leaves the former content readable, and several
slots change together. Readers follow the log: of each slot the folder of the last commit counts.
One writer at a time may set a slot; writers of different slots don't meet.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.session import remove

LOG = "version long, slot string, folder string"
COMMIT = "commit"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).parquet(f"{path}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def live(spark: SparkSession, path: str, prefix: str = "") -> dict[str, str]:
    """Slots below ``prefix`` and their folders: a row for each load or run date, as a folder listing has."""
    log = _log(spark, path)
    if log is None:
        return {}
    newest = log.filter(F.startswith("slot", F.lit(prefix))).groupBy("slot").agg(F.max(F.struct("version", "folder")).alias("last"))
    return {r.slot: r.folder for r in newest.select("slot", "last.folder").filter("folder is not null").collect()}


def version(spark: SparkSession, path: str) -> int:
    """The last commit's number; 0 for a table without any."""
    log = _log(spark, path)
    return 0 if log is None else log.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def stage(rows: DataFrame, path: str, kind: str, partition_by: list[str] | None = None) -> str:
    """Write rows that no reader sees yet; the folder to be named in a commit."""
    folder = uuid.uuid4().hex
    rows.write.partitionBy(*(partition_by or [])).parquet(f"{path}/data/{kind}/{COMMIT}={folder}")
    return folder


def commit(spark: SparkSession, path: str, slots: dict[str, str | None]) -> int:
    """Let readers see staged folders; ``None`` removes a slot. All slots change at once."""
    if not slots:
        return version(spark, path)
    number = version(spark, path) + 1
    rows = spark.createDataFrame([(number, slot, folder) for slot, folder in slots.items()], LOG)
    rows.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return number


def publish(rows: DataFrame, path: str, slot: str) -> int:
    """Make ``rows``, even none, the whole content of one slot."""
    return commit(rows.sparkSession, path, {slot: stage(rows, path, slot.split("/")[0])})


def read(spark: SparkSession, path: str, kind: str, schema: T.StructType, slots: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The live rows of a kind, of all its slots or the named ones; no slot gives no rows.

    ``schema`` includes the columns that folders are partitioned by, and may name ``COMMIT``, the
    folder of a row. Columns a file lacks are null.
    """
    found = live(spark, path, f"{kind}/{prefix}")
    folders = [f for s, f in found.items() if slots is None or s in slots]
    if not folders:
        return spark.createDataFrame([], schema)
    root = f"{path}/data/{kind}"
    stored = T.StructType([f for f in schema.fields if f.name != COMMIT] + [T.StructField(COMMIT, T.StringType())])
    rows = spark.read.schema(stored).option("basePath", root).parquet(*(f"{root}/{COMMIT}={f}" for f in sorted(folders)))
    return rows.select(*(f.name for f in schema.fields))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove folders that the last ``keep`` versions of the log don't need; how many went.

    Folders that are staged and not committed yet stay.
    """
    log = _log(spark, path)
    if log is None:
        return 0
    oldest = version(spark, path) - keep + 1
    rows = [r for r in log.collect() if r.version <= oldest]
    newest: dict[str, tuple] = {}
    for r in rows:
        newest[r.slot] = max(newest.get(r.slot, (0, "")), (r.version, r.folder or ""))
    dead = [r for r in rows if r.folder and r.folder != newest[r.slot][1]]
    gone = 0
    for r in dead:
        gone += remove(spark, f"{path}/data/{r.slot.split('/')[0]}/{COMMIT}={r.folder}")
    return gone
