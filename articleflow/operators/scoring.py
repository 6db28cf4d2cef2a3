"""Scoring of prompts by pluggable functions, a batch of rows at a time."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.operators.incremental import spread_join
from articleflow.session import settle
from articleflow.sources import snapshots

Scorer = Callable[[list[str]], list[str | None]]


def score(df: DataFrame, scorers: dict[str, Scorer], prompt: str = "prompt") -> DataFrame:
    """Add ``<name>_raw`` per scorer: its answer to the prompt, or null.

    All scorers see the row in the same task, so their answers need no join. Where one raises,
    or answers a wrong number of prompts, it is asked again for each half, down to the prompt at
    fault, which alone gives null: an answer does not depend on how rows fall into batches.
    Retries belong to the scorer.
    """
    keep = [c for c in df.columns if c != prompt]
    types = dict(df.dtypes)
    names = [f"{n}_raw" for n in scorers]
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], *[f"`{n}` string" for n in names]])

    def answers(fn: Scorer, prompts: list[str]) -> list[str | None]:
        if not prompts:
            return []
        try:
            out = list(fn(prompts))
        except Exception:
            out = None
        if out is not None and len(out) == len(prompts):
            return out
        if len(prompts) == 1:
            return [None]
        half = len(prompts) // 2
        return answers(fn, prompts[:half]) + answers(fn, prompts[half:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prompts = batch.column(prompt).to_pylist()
            columns = [pa.array(answers(fn, prompts), pa.string()) for fn in scorers.values()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *columns], names=[*keep, *names]
            )

    return df.mapInArrow(run, schema)


ANSWERS = T.StructType([T.StructField(c, T.StringType()) for c in ("version", "digest", "raw")])


def score_once(
    df: DataFrame, scorers: dict[str, tuple[str, Scorer]], path: str, prompt: str = "prompt", parts: int = 4
) -> DataFrame:
    """``score`` with a store of answers below ``path``: equal prompts are scored once, in all runs together.

    ``scorers`` maps a name to a version and a function; answers are kept by version and SHA-256 of the prompt,
    so a new version is asked anew. Only distinct prompts without an answer are scored, in ``parts``
    that are committed one by one: a run that fails goes on from there when it is repeated. A
    failure (null) is not kept and is asked again by the next run. A null prompt has a null answer.
    Rows are read twice: pass a stored table.
    """
    spark = df.sparkSession
    rows = df.withColumn("_digest", F.sha2(prompt, 256))
    asked = rows.filter(F.col(prompt).isNotNull()).groupBy("_digest").agg(F.first(prompt).alias(prompt))
    for name, (version, fn) in scorers.items():
        kind = f"answers/{version}/"
        known = snapshots.read(spark, path, "answers", ANSWERS, prefix=f"{version}/").select(F.col("digest").alias("_digest")).distinct()
        missing = settle(asked.join(known, "_digest", "left_anti").withColumn("_part", F.pmod(F.xxhash64("_digest"), F.lit(parts))), "missing")
        present = {r["_part"] for r in missing.select("_part").distinct().collect()}
        for part in sorted(present):
            got = score(missing.filter(F.col("_part") == part).drop("_part"), {"new": fn}, prompt)
            kept = got.filter(F.col("new_raw").isNotNull()).select(F.lit(version).alias("version"), F.col("_digest").alias("digest"), F.col("new_raw").alias("raw"))
            snapshots.publish(kept, path, f"{kind}{uuid.uuid4().hex}")
    out = rows
    for name, (version, _) in scorers.items():
        stored = snapshots.read(spark, path, "answers", ANSWERS, prefix=f"{version}/")
        # Two runs at a time may both have asked; one answer counts for all rows.
        answers = stored.groupBy(F.col("digest").alias("_digest")).agg(F.min("raw").alias(f"{name}_raw"))
        out = spread_join(out, answers, ["_digest"], "left")
    return out.drop("_digest", prompt)


def stored_answers(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The kept answers of one scorer version (version, digest, raw)."""
    return snapshots.read(spark, path, "answers", ANSWERS, prefix=f"{version}/")


def keyword_scorer(terms: list[str], per_hit: float = 0.25) -> Scorer:
    """A deterministic scorer for tests: relevant when any term occurs."""

    def run(prompts: list[str]) -> list[str | None]:
        out = []
        for text in prompts:
            hits = sum(t in text.lower() for t in terms)
            out.append(
                json.dumps(
                    {"is_relevant": hits > 0, "confidence_score": min(1.0, per_hit * hits),
                     "reasoning": f"{hits} terms"}
                )
            )
        return out

    return run
