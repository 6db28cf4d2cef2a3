"""Ordered scans over listings, without putting one source into one task.

A running value over ``(keys, pos)`` is computed in two steps. Rows are cut into
chunks of ``2**CHUNK_BITS`` consecutive positions; since ``pos`` is unique within its
keys, a chunk is bounded however hot the key is. Each chunk is scanned by a window of
its own; chunk totals, one small row per 65,536 positions, are scanned per key, and
every row adds what its chunk carries in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.operators.incremental import spread_join
from articleflow.session import settle

CHUNK_BITS = 16
# ``monotonically_increasing_id`` keeps the place within a partition in so many bits.
_PLACE_BITS = 33


def _chunk(col: Column) -> Column:
    return F.shiftright(col.cast("bigint"), CHUNK_BITS)


def _plus(total: Column, more: Column) -> Column:
    return F.coalesce(total, F.lit(0)) + F.coalesce(more, F.lit(0))


class _Measure:
    """A running sum, or the running maximum of an orderable value."""

    def __init__(self, name: str, value: Column, kind: str):
        self.name, self.value, self.kind = name, value, kind

    def whole(self, col: Column) -> Column:
        return F.sum(col) if self.kind == "sum" else F.max(col)

    def merge(self, own: Column, carried: Column) -> Column:
        if self.kind == "sum":
            return _plus(own, carried)
        # ``greatest`` skips nulls: a chunk without a value passes on what came in.
        return F.greatest(own, carried)


def _carry_in(parts: DataFrame, keys: list[str], measures: list[_Measure]) -> DataFrame:
    """Values of all earlier chunks, from chunk totals ``parts(keys, _c, <name>)``."""
    before = W.partitionBy(*keys).orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    return parts.select(
        *keys, "_c", *[m.whole(F.col(m.name)).over(before).alias(f"_in_{m.name}") for m in measures]
    )


def _chunk_totals(rows: DataFrame, keys: list[str], measures: list[_Measure]) -> DataFrame:
    """Totals per chunk. Numbers go through a hash aggregate on the map side; other
    values would be sorted for it, so only the rows that have one are looked at."""
    plain = [m for m in measures if isinstance(rows.schema[m.name].dataType, T.NumericType)]
    chunk = [*keys, "_c"]
    totals = rows.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("_rows"), *[m.whole(F.col(m.name)).alias(m.name) for m in plain]
    )
    for m in measures:
        if m not in plain:
            some = rows.filter(F.col(m.name).isNotNull()).groupBy(*chunk).agg(
                m.whole(F.col(m.name)).alias(m.name)
            )
            totals = totals.join(some, chunk, "left")
    return totals.drop("_rows")


def running(
    df: DataFrame,
    keys: list[str],
    pos: str,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Add running sums and maxima along ``pos`` within ``keys``.

    ``pos`` must be a whole number, unique within ``keys``. With ``inclusive`` a row
    counts itself.
    """
    measures = [_Measure(n, c, "sum") for n, c in (sums or {}).items()]
    measures += [_Measure(n, c, "max") for n, c in (maxes or {}).items()]
    rows = df.withColumns({"_c": _chunk(F.col(pos)), **{m.name: m.value for m in measures}})
    parts = _chunk_totals(rows, keys, measures)
    carried = _carry_in(parts, keys, measures)
    last = 0 if inclusive else -1
    frame = W.partitionBy(*keys, "_c").orderBy(pos).rowsBetween(W.unboundedPreceding, last)
    local = rows.withColumns({m.name: m.whole(F.col(m.name)).over(frame) for m in measures})
    out = local.join(carried, [*keys, "_c"], "left").withColumns(
        {m.name: m.merge(F.col(m.name), F.col(f"_in_{m.name}")) for m in measures}
    )
    return out.drop("_c", *[f"_in_{m.name}" for m in measures])


def _before_cut(df: DataFrame, cuts: DataFrame, keys: list[str], pos: str) -> DataFrame:
    joined = spread_join(df, cuts, keys, "left")
    return joined.filter(F.col("_cut").isNull() | (F.col(pos) < F.col("_cut"))).drop("_cut")


def take_while(
    df: DataFrame, keys: list[str], pos: str, recent: Column, stops: Column | None = None
) -> DataFrame:
    """Recent rows before the first one, per key, that is not recent.

    With ``stops`` only rows for which it is true end the scan; others are just dropped.
    Only the recent rows, a small part of a history, meet the cut positions.
    """
    ends = ~F.coalesce(recent, F.lit(False))
    if stops is not None:
        ends = ends & stops
    cuts = df.filter(ends).groupBy(*keys).agg(F.min(pos).alias("_cut"))
    return _before_cut(df.filter(recent), cuts, keys, pos)


def until_seen_streak(
    df: DataFrame, keys: list[str], pos: str, seen: Column, limit: int | Column = 30,
    old: Column | None = None,
) -> DataFrame:
    """Unseen rows before the scan stops, per key.

    It stops at an ``old`` row, or at the row that completes ``limit`` consecutive
    seen ones. Blank links and repeats must be removed before. The age stop goes
    first, so that streaks are looked for among recent rows only.
    """
    if old is not None:
        df = take_while(df, keys, pos, ~F.coalesce(old, F.lit(False)))
    is_seen = F.coalesce(seen, F.lit(False))
    marks = df.select(*keys, pos, is_seen.alias("_seen"), F.lit(limit).alias("_limit"))
    cuts = _streaks(marks, keys, pos).filter(F.col("_streak") >= F.col("_limit")).groupBy(*keys).agg(F.min(pos).alias("_cut"))
    return _before_cut(df.filter(~is_seen), cuts, keys, pos)


def _streaks(marks: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Length of the run of seen rows that ends at each row.

    A row's run is its rank less the rank of the last unseen row. Both are taken
    within the chunk; what comes before is known from one row per chunk.
    """
    chunk = [*keys, "_chunk"]
    frame = W.partitionBy(*chunk).orderBy(pos)
    local = marks.withColumn("_chunk", _chunk(F.col(pos))).withColumn("_rank", F.row_number().over(frame))
    reset = F.when(~F.col("_seen"), F.col("_rank"))
    sizes = local.groupBy(*chunk).agg(
        F.max("_rank").cast("bigint").alias("_size"), F.max(reset).alias("_last")
    )
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    placed = sizes.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    carried = placed.withColumn("_before", F.max(F.col("_base") + F.col("_last")).over(before)).select(
        *chunk, "_base", "_before"
    )
    rows = local.withColumn("_own", F.max(reset).over(frame)).join(carried, chunk, "left")
    last_reset = F.greatest(F.col("_base") + F.col("_own"), F.col("_before"), F.lit(0))
    return rows.withColumn("_streak", F.col("_base") + F.col("_rank") - last_reset)


def first_n(df: DataFrame, keys: list[str], pos: str, n: int | Column) -> DataFrame:
    """The first ``n`` rows per key; as a column, the same for all rows of a key, 0 is all.

    Ranked per chunk first, then per key: a hot key reaches its last task with at most
    ``n`` rows per chunk. A fixed ``n`` is also cut on the map side by the window limit.
    Rows of a key without a limit stay in their chunks.
    """
    chunk = F.shiftright(F.col(pos).cast("bigint"), CHUNK_BITS)
    if isinstance(n, int):
        stay, within = F.lit(None).cast("bigint"), F.col("_n") <= n
    else:
        stay, within = F.when(n <= 0, F.col("_c")), (n <= 0) | (F.col("_n") <= n)
    out = df.withColumn("_c", chunk)
    near = W.partitionBy(*keys, "_c").orderBy(pos)
    out = out.withColumn("_n", F.row_number().over(near)).filter(within)
    out = out.withColumn("_c", stay)
    return (
        out.withColumn("_n", F.row_number().over(W.partitionBy(*keys, "_c").orderBy(pos)))
        .filter(within).drop("_c", "_n")
    )


def numbered(df: DataFrame, pos: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Number the rows from 1 along ``pos`` (per key, or over the whole table)."""
    return running(df, keys or [], pos, sums={name: F.lit(1)})


def numbered_by_range(
    df: DataFrame, order: list[str], name: str, keys: list[str] | None = None, ranges: int | None = None
) -> DataFrame:
    """Number the rows from 1 along ``order`` (per key, or over the whole table), whatever its values.

    The rows are dealt out by ranges of (keys, order), so a task has its range and no more, be the
    positions sparse, no numbers at all or all of one key. They are written once in that
    order; a row's number is its place in its range after the sizes of the ranges before, of which there is
    one for each task. Nulls come first; rows that are equal in ``order`` are numbered as they were written.
    """
    keys = keys or []
    by = [F.col(c) for c in [*keys, *order]]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    placed = settle(dealt.sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", _PLACE_BITS).alias("_range")
    sizes = placed.groupBy(part).agg(F.count("*").alias("_size"))
    # A row for each range: as many as there were tasks.
    before = F.coalesce(F.sum("_size").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))
    rows = placed.withColumn("_range", part).join(F.broadcast(offsets), "_range")
    number = F.col("_before") + F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1) + 1
    rows = rows.withColumn(name, number).drop("_range", "_before", "_place")
    if not keys:
        return rows
    first = rows.groupBy(*keys).agg(F.min(name).alias("_first"))
    # A null key is one key here; a join would lose it.
    same = [F.struct(*keys).alias("_key")]
    joined = spread_join(rows.withColumn("_key", *[F.to_json(s) for s in same]), first.select(F.to_json(*same).alias("_key"), "_first"), ["_key"], "inner")
    return joined.withColumn(name, F.col(name) - F.col("_first") + 1).drop("_key", "_first")


def first_n_by_range(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows per key along ``order``; no task gets more than its range."""
    return numbered_by_range(df, order, "_n", keys).filter(F.col("_n") <= n).drop("_n")


def fill_down(
    df: DataFrame, keys: list[str], pos: str, is_header: Column, value: Column, name: str
) -> DataFrame:
    """Give each row the value of the last header at or before it.

    A header with a null value clears it: its rows stay null until the next header.
    """
    head = F.when(is_header, F.struct(F.col(pos).alias("p"), value.alias("v")))
    out = running(df, keys, pos, maxes={"_head": head})
    return out.withColumns(
        {name: F.col("_head")["v"], f"{name}_pos": F.col("_head")["p"]}
    ).drop("_head")


def line_groups(df: DataFrame, keys: list[str], pos: str, line: str, dated: Column, link: str | None = None) -> DataFrame:
    """Cut a stream of text lines into items, each starting at a dated line.

    Title: the last line holding ``[PDF`` or ending in ``]``, else the line after
    the date. Category: the first other line longer than 10 characters.
    Lines before the first date belong to no item. With ``link``, a column of the lines, an
    item has the link of its title's line.
    """
    text = F.col(line)
    heads = fill_down(df, keys, pos, dated, text, "_date").filter(F.col("_date_pos").isNotNull())
    body = F.col(pos) > F.col("_date_pos")
    marked = body & (F.contains(text, F.lit("[PDF")) | text.endswith("]"))
    other = body & ~marked & (F.length(text) > 10)
    items = heads.groupBy(*keys, F.col("_date_pos").alias(pos)).agg(
        F.max(F.when(F.col(pos) == F.col("_date_pos"), text)).alias("date_raw"),
        F.max_by(F.when(marked, text), F.when(marked, F.col(pos))).alias("_marked"),
        F.min_by(F.when(body, text), F.when(body, F.col(pos))).alias("_next"),
        F.min_by(F.when(other, text), F.when(other, F.col(pos))).alias("_category"),
        *([] if link is None else [
            F.max_by(F.when(marked, F.col(link)), F.when(marked, F.col(pos))).alias("_marked_link"),
            F.min_by(F.when(body, F.col(link)), F.when(body, F.col(pos))).alias("_next_link"),
        ]),
    )
    # An item without lines of its own is followed directly by the next date line.
    backwards = items.withColumn("_back", -F.col(pos))
    after = F.struct(F.col("_back").alias("p"), F.col("date_raw").alias("v"))
    items = running(backwards, keys, "_back", maxes={"_after": after}, inclusive=False)
    return items.select(
        *keys, pos, "date_raw",
        F.coalesce("_marked", "_next", F.col("_after")["v"], F.lit("")).alias("title"),
        F.coalesce("_category", F.lit("")).alias("category"),
        *([] if link is None else [
            F.coalesce(F.when(F.col("_marked").isNotNull(), F.col("_marked_link")).otherwise(F.col("_next_link")), F.lit("")).alias("link")
        ]),
    )


def newest_first(df: DataFrame, keys: list[str], day: str, pos: str) -> DataFrame:
    """Global order by key, newest day first, listing position last: a total order."""
    return df.orderBy(*keys, F.col(day).desc(), F.col(pos))
