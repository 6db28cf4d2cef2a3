"""Canonical rows, repeats, and what is already known.

Every key comparison is an equi-join. Repeats are removed before the join, under
a window limit of one row, so that each map task passes on at most one row of a
hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from articleflow.functions.text import clean_multi_line, clean_one_line, first_filled, strip, text_of
from articleflow.schema import ARTICLE_FIELDS, MULTI_LINE_FIELDS, VERDICT_FIELDS
from articleflow.session import settle

_KEY = "_dedupe_key"
# The column an index of keys is partitioned by, and how many values it has.
PREFIX, PREFIXES = "_prefix", 32


def canonicalize(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The twelve article columns, cleaned; absent ones empty, others dropped."""

    def cleaned(name: str) -> Column:
        if name not in df.columns:
            return F.lit("").alias(name)
        clean = clean_multi_line if name in MULTI_LINE_FIELDS else clean_one_line
        return clean(F.col(name)).alias(name)

    return df.select(*(keep or []), *[cleaned(n) for n in ARTICLE_FIELDS])


def with_key(df: DataFrame, key: Column, pos: str) -> DataFrame:
    """Add the comparison key; a row without one gets a key no other row has."""
    alone = F.concat(F.lit("\x00"), F.col(pos).cast("string"))
    return df.withColumn(_KEY, F.when(text_of(key) == "", alone).otherwise(key))


def _first_per_key(keyed: DataFrame, pos: str) -> DataFrame:
    order = W.partitionBy(_KEY).orderBy(pos)
    return (
        keyed.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")
    )


def first_per_key(df: DataFrame, key: Column, pos: str) -> DataFrame:
    """First row by ``pos`` per key wins; rows with an empty key all stay."""
    return _first_per_key(with_key(df, key, pos), pos).drop(_KEY)


def first_link_per_source(df: DataFrame, source: str, link: str, *order: str | Column) -> DataFrame:
    """In-run repeats of a link within one source; the first by ``order`` stays."""
    ranked = W.partitionBy(source, link).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") == 1).drop("_n")


def known_keys(history: DataFrame, column: str, stored: bool = False) -> DataFrame:
    """Trimmed, non-empty keys of the history, one column read.

    ``stored`` says that our own sinks wrote the history: its keys are clean and are
    compared as they are, which lets a table bucketed by the key keep its layout.
    """
    name = column if column in history.columns else "link"
    if name not in history.columns:
        return history.sparkSession.createDataFrame([], f"{_KEY} string")
    key = F.col(name) if stored else strip(text_of(F.col(name)))
    return history.select(key.alias(_KEY)).filter(F.col(_KEY) != "")


def key_prefix(key: Column) -> Column:
    """The partition of an index that a key is in."""
    return F.pmod(F.xxhash64(key), F.lit(PREFIXES)).cast("int")


def _known(keyed: DataFrame, history: DataFrame, column: str, stored: bool = False) -> DataFrame:
    """The batch's keys that the history has.

    The history is reduced to keys of this batch first. A batch below the broadcast
    threshold never shuffles the history; a larger one shuffles its key column only,
    and the reduced keys stay partitioned for the join that follows. ``distinct``
    keeps a key that fills a third of either side from meeting itself. Of an index only the
    prefixes of the batch are read, when the batch is small enough to be broadcast; the condition on
    its keys lets Spark see that it narrows the scan.
    """
    wanted = keyed.select(_KEY).distinct()
    if PREFIX in history.columns:
        wanted = wanted.filter(F.col(_KEY) != "").withColumn(PREFIX, key_prefix(F.col(_KEY)))
        index = history.select(F.col(column).alias(_KEY), PREFIX)
        return index.join(wanted, [PREFIX, _KEY], "left_semi").select(_KEY).distinct()
    return known_keys(history, column, stored).join(wanted, _KEY, "left_semi").distinct()


HOT_ROWS = 100_000
HOT_KEYS = 10_000
SPREAD = 64


def _broadcast(few: DataFrame) -> bool:
    """Whether Spark's own estimate lets the table be sent to all tasks."""
    spark = few.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = few._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit > 0 and int(str(size)) <= limit


def sized(few: DataFrame, name: str) -> DataFrame:
    """``few`` with a size that Spark knows: an estimate too large to broadcast by is replaced by the
    size of the table once it is written."""
    return few if _broadcast(few) else settle(few, name)


def spread_join(rows: DataFrame, few: DataFrame, keys: list[str], how: str, hot_rows: int | None = None) -> DataFrame:
    """Join rows to a table with one row for each key, whatever share of the rows a key has.

    A table below the broadcast threshold is simply joined. Otherwise keys with more than ``hot_rows`` rows are
    counted first (partial sums, so no task sees the rows of one). Their rows are spread over ``SPREAD`` join keys
    and only their row of ``few`` is repeated; a key that is not hot has one row on the small side as
    before. The ``HOT_KEYS`` hottest are sent to all tasks; any further key has less than one in
    ``HOT_KEYS`` of the rows. Rows are dealt by their own columns, so a task that runs again deals them alike.
    """
    if _broadcast(few):
        return rows.join(few, keys, how)
    limit = HOT_ROWS if hot_rows is None else hot_rows
    hot = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
    hot = F.broadcast(hot.orderBy(F.col("_rows").desc()).limit(HOT_KEYS).select(*keys, F.lit(True).alias("_hot")))
    own = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*own), F.lit(SPREAD))).otherwise(F.lit(0))
    left = rows.join(hot, keys, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    right = few.join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def not_in_history(df: DataFrame, history: DataFrame, pos: str, by: str = "uid") -> DataFrame:
    """Drop rows whose key is in the history; rows with an empty key always stay."""
    keyed = with_key(df, F.col(by), pos)
    return spread_join(keyed, _known(keyed, history, by), [_KEY], "left_anti").drop(_KEY)


def in_history(df: DataFrame, history: DataFrame, pos: str, by: str = "url") -> DataFrame:
    keyed = with_key(df, F.col(by), pos)
    return spread_join(keyed, _known(keyed, history, by), [_KEY], "left_semi").drop(_KEY)


def mark_known(df: DataFrame, history: DataFrame, by: str, flag: str) -> DataFrame:
    """Add whether the row's key is in the history."""
    keyed = df.withColumn(_KEY, F.col(by))
    known = _known(keyed, history, by).withColumn(flag, F.lit(True))
    return (
        spread_join(keyed, known, [_KEY], "left").drop(_KEY)
        .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    )


def new_rows(
    df: DataFrame, history: DataFrame, pos: str, dedupe_by: str = "uid", stored: bool = False
) -> DataFrame:
    """Rows to load: first of each key in the batch, and not yet in the history.

    Both steps share one shuffle on the key. Any other ``dedupe_by`` keeps all rows.
    """
    if dedupe_by not in ("uid", "url"):
        return df
    keyed = with_key(df, F.col(dedupe_by), pos)
    known = _known(keyed, history, dedupe_by, stored)
    return _first_per_key(keyed, pos).join(known, _KEY, "left_anti").drop(_KEY)


def union_sources(frames: list[tuple[str, DataFrame]], pos: str = "pos") -> DataFrame:
    """All sources under one another; ``source_order`` is the job order.

    ``batch_pos`` orders rows by source order, then position, in one number, so that
    the first job wins a repeat. It leaves 48 bits for the position.
    """
    out: DataFrame | None = None
    for order, (_, df) in enumerate(frames):
        tagged = df.withColumns(
            {
                "source_order": F.lit(order).cast("bigint"),
                "batch_pos": F.lit(order << 48).cast("bigint") + F.col(pos).cast("bigint"),
            }
        )
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def align_columns(df: DataFrame) -> DataFrame:
    """Article and verdict columns in fixed order; absent ones empty, nothing reset."""
    names = ARTICLE_FIELDS + VERDICT_FIELDS[1:]
    return df.select(
        *[
            text_of(F.col(n)).alias(n) if n in df.columns else F.lit("").alias(n) for n in names
        ]
    )


def write_back(history: DataFrame, batch: DataFrame, pos: str, columns: list[str]) -> DataFrame:
    """History with the batch's values where it has any; the last batch row per uid wins."""
    newest = batch.groupBy("uid").agg(
        F.max_by(F.struct(*columns), F.col(pos)).alias("_new")
    )
    named = text_of(F.col("uid")) != ""
    joined = spread_join(history.filter(named), newest.filter(named), ["uid"], "left")
    joined = joined.withColumns({c: F.coalesce(F.col("_new")[c], F.col(c)) for c in columns}).drop("_new")
    # Rows without a uid have nothing to meet.
    return joined.select(*history.columns).unionByName(history.filter(~named))


def backfill_candidates(
    listed: DataFrame, history: DataFrame, pos: str, limit: int = 20
) -> DataFrame:
    """Listed links that are known but stored without content, in listing order.

    ``limit`` is the most a run refetches; the rest come up again the next run.
    """
    empty = history.filter(text_of(F.col("content")) == "")
    return in_history(listed, empty, pos, by="url").orderBy(pos).limit(limit)


def apply_backfill(history: DataFrame, updates: DataFrame, pos: str) -> DataFrame:
    """Fill empty content and abstract in the history from refetched rows."""
    first = (
        updates.filter(text_of(F.col("url")) != "")
        .groupBy("url")
        .agg(F.min_by(F.struct("abstract", "content"), F.col(pos)).alias("_new"))
    )
    # Only a row with a gap and a link can change; the rest of the history is not moved.
    gap = (text_of(F.col("content")) == "") | (text_of(F.col("abstract")) == "")
    open_rows = gap & (text_of(F.col("url")) != "")
    joined = spread_join(history.filter(open_rows), first, ["url"], "left")
    filled = joined.withColumns(
        {c: first_filled(F.col(c), F.col("_new")[c]) for c in ("abstract", "content")}
    ).drop("_new")
    return filled.select(*history.columns).unionByName(history.filter(~open_rows))


def pending_runs(requested: DataFrame, digests: DataFrame) -> DataFrame:
    """Run dates that have no digest yet."""
    return requested.join(digests.select("run_date").distinct(), "run_date", "left_anti")
