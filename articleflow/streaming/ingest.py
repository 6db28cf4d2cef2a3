"""Incremental ingest as a stream: new files, window, repeats, history."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.operators.filters import lookback
from articleflow.operators.incremental import canonicalize, new_rows
from articleflow.sources.history import read_index
from articleflow.sources.history import write_load as write_indexed_load
from articleflow.sources.tables import create_history, read_history, write_load


def load_batch(
    batch: DataFrame, history: DataFrame, now: Column | date, pos: str, days: int = 1,
    stored: bool = False,
) -> DataFrame:
    """Recent, first-seen, unknown rows of a batch, as canonical articles.

    ``batch`` needs ``published_on`` and ``uid``; without a position its rows are ordered by
    their content, so the same batch gives the same rows again. Texts are cleaned last, so
    only rows that stay pay for it.
    """
    if pos not in batch.columns:
        batch = batch.withColumn(pos, F.xxhash64(*batch.columns))
    recent = lookback(batch, now, days)
    return canonicalize(new_rows(recent, history, pos, stored=stored), keep=[pos])


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run that a checkpoint belongs to; kept beside its own files, so a new checkpoint is a
    new run."""
    path = f"{checkpoint}/run"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException:
        spark.range(1).select(F.lit(uuid.uuid4().hex)).write.text(path)
        return spark.read.text(path).first()[0]


def ingest(
    stream: DataFrame, history_path: str, checkpoint: str, pos: str,
    clock: Callable[[int], Column | date], days: int = 1, indexed: bool = False, **writer: str,
):
    """Start the ingest over what is there and return the query.

    A micro-batch writes the history partition of its own run and id, and looks up all
    others but those of later batches of this run, so a repeated batch gives the same rows
    again and what other runs and loads stored stays. With ``indexed`` the history is one of
    ``sources.history``: a micro-batch looks its keys up in the index, and its rows and keys appear
    together. ``clock`` maps a batch id to the time its window is
    measured from.
    """
    spark = stream.sparkSession
    if not indexed:
        create_history(spark, history_path)
    run_id = run_of(spark, checkpoint)
    known, write = (read_index, write_indexed_load) if indexed else (read_history, write_load)

    def load(batch: DataFrame, batch_id: int) -> None:
        history = known(batch.sparkSession, history_path)
        earlier = history.filter((F.col("run_id") != run_id) | (F.col("load_id") < batch_id))
        rows = load_batch(batch, earlier, clock(batch_id), pos, days, stored=True)
        write(rows, history_path, batch_id, run_id)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).options(**writer)
        .trigger(availableNow=True).start()
    )
