"""Queries over ordered listings and event streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from articleflow.operators import ordered as O
from articleflow.operators.filters import in_lookback
from articleflow.plans import fixtures as X
from articleflow.plans.registry import query

WINDOW_START = "DATE '2024-01-28'"


@query(
    "take_while_recent",
    X.with_sql(
        X.LISTING,
        f"""
        SELECT source, pos, url FROM (
          SELECT *, min(CASE WHEN published_on >= {WINDOW_START} THEN 1 ELSE 0 END)
            OVER (PARTITION BY source ORDER BY pos ROWS UNBOUNDED PRECEDING) AS ok FROM listing) x
        WHERE ok = 1""",
    ),
)
def take_while_recent(spark, sf_dir):
    recent = in_lookback(F.col("published_on"), X.NOW, days=3)
    return O.take_while(X.listing(spark, sf_dir), ["source"], "pos", recent).select("source", "pos", "url")


@query(
    "source_cap",
    X.with_sql(
        X.LISTING,
        f"""
        SELECT source, pos, url FROM (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos) AS n FROM listing
          WHERE published_on >= {WINDOW_START}) x
        WHERE n <= 20""",
    ),
)
def source_cap(spark, sf_dir):
    kept = X.listing(spark, sf_dir).filter(in_lookback(F.col("published_on"), X.NOW, days=3))
    return O.first_n(kept, ["source"], "pos", 20).select("source", "pos", "url")


@query(
    "listing_sort",
    X.with_sql(
        X.LISTING,
        """
        SELECT source, CAST(published_on AS VARCHAR) AS published_at, pos FROM listing
        ORDER BY source, published_on DESC, pos""",
    ),
)
def listing_sort(spark, sf_dir):
    ordered = O.newest_first(X.listing(spark, sf_dir), ["source"], "published_on", "pos")
    return ordered.select("source", F.col("published_on").cast("string").alias("published_at"), "pos")


def events(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    return e.select("user_id", F.col("event_id").alias("pos"), "event_type", "ts")


EVENTS = """
marks AS (
  SELECT user_id, event_id AS pos, event_type, event_type IN ('click', 'view', 'error') AS seen FROM events)"""


@query(
    "seen_streak_cutoff",
    X.with_sql(
        EVENTS + """,
        islands AS (
          SELECT *, sum(CASE WHEN seen THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY pos) AS island FROM marks),
        runs AS (
          SELECT *, sum(CASE WHEN seen THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id, island ORDER BY pos) AS run FROM islands),
        cuts AS (SELECT user_id, min(pos) AS cut FROM runs WHERE seen AND run >= 5 GROUP BY user_id)""",
        """
        SELECT m.user_id, m.pos FROM marks m LEFT JOIN cuts c ON m.user_id = c.user_id
        WHERE NOT m.seen AND (c.cut IS NULL OR m.pos < c.cut)""",
    ),
)
def seen_streak_cutoff(spark, sf_dir):
    seen = F.col("event_type").isin("click", "view", "error")
    return O.until_seen_streak(events(spark, sf_dir), ["user_id"], "pos", seen, limit=5).select("user_id", "pos")


@query(
    "header_fill",
    X.with_sql(
        """
        grouped AS (
          SELECT user_id, event_id AS pos, event_type, ts,
                 count(*) FILTER (WHERE event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id) AS grp
          FROM events),
        dated AS (
          SELECT *, first_value(CASE WHEN event_type = 'signup' AND pos % 4 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END)
            OVER (PARTITION BY user_id, grp ORDER BY pos) AS day FROM grouped)""",
        "SELECT user_id, pos, day FROM dated WHERE grp > 0 AND event_type <> 'signup' AND day IS NOT NULL",
    ),
)
def header_fill(spark, sf_dir):
    """Sign-ups are date headers, every fourth position has an unreadable date."""
    header = F.col("event_type") == "signup"
    value = F.when(F.col("pos") % 4 != 0, F.col("ts").cast("date").cast("string"))
    filled = O.fill_down(events(spark, sf_dir), ["user_id"], "pos", header, value, "day")
    return filled.filter(~header & F.col("day").isNotNull()).select("user_id", "pos", "day")


LINE_SQL = """CASE event_type WHEN 'signup' THEN 'Jan. ' || CAST(event_id % 28 + 1 AS VARCHAR) || ', 2024'
    WHEN 'click' THEN 'Paper ' || CAST(event_id AS VARCHAR) || ' [PDF 10KB]'
    WHEN 'error' THEN 'short ' || CAST(event_id % 10 AS VARCHAR)
    ELSE 'Category no ' || CAST(event_id AS VARCHAR) END"""


@query(
    "line_groups",
    X.with_sql(
        f"""
        lines AS (SELECT user_id, event_id AS pos, event_type = 'signup' AS dated, {LINE_SQL} AS line FROM events),
        grouped AS (
          SELECT *, count(*) FILTER (WHERE dated) OVER (PARTITION BY user_id ORDER BY pos) AS grp,
                 lead(line) OVER (PARTITION BY user_id ORDER BY pos) AS next_line FROM lines),
        items AS (
          SELECT user_id, min(pos) AS pos, min(line) FILTER (WHERE dated) AS date_raw,
                 max_by(line, pos) FILTER (WHERE NOT dated AND (contains(line, '[PDF') OR suffix(line, ']'))) AS marked,
                 min(next_line) FILTER (WHERE dated) AS next_line,
                 min_by(line, pos) FILTER (WHERE NOT dated AND NOT (contains(line, '[PDF') OR suffix(line, ']'))
                                           AND length(line) > 10) AS category
          FROM grouped WHERE grp > 0 GROUP BY user_id, grp)""",
        """
        SELECT user_id, pos, date_raw, coalesce(marked, next_line, '') AS title, coalesce(category, '') AS category
        FROM items""",
    ),
)
def line_groups(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    kind = F.col("event_type")
    line = (
        F.when(kind == "signup", F.concat(F.lit("Jan. "), (F.col("event_id") % 28 + 1).cast("string"), F.lit(", 2024")))
        .when(kind == "click", F.concat(F.lit("Paper "), number, F.lit(" [PDF 10KB]")))
        .when(kind == "error", F.concat(F.lit("short "), (F.col("event_id") % 10).cast("string")))
        .otherwise(F.concat(F.lit("Category no "), number))
    )
    lines = e.select("user_id", F.col("event_id").alias("pos"), line.alias("line"))
    dated = F.col("line").rlike(r"^\+?\s*[A-Za-z]+\.\s*\d{1,2},\s*\d{4}")
    return O.line_groups(lines, ["user_id"], "pos", "line", dated)


# Positions like hash values: no two rows stand near one another.
SPARSE = X.STAGED + """,
sparse AS (SELECT source, pos, (pos * 2654435761) % 4294967296 * 1048576 AS place FROM staged)"""


def sparse(spark, sf_dir):
    place = (F.col("pos") * F.lit(2654435761)) % F.lit(4294967296) * F.lit(1048576)
    return X.staged(spark, sf_dir).select("source", "pos", place.alias("place"))


@query("numbered_sparse", X.with_sql(SPARSE, "SELECT pos, row_number() OVER (ORDER BY place) AS no, row_number() OVER (PARTITION BY source ORDER BY place) AS source_no FROM sparse"))
def numbered_sparse(spark, sf_dir):
    """Rows numbered over the table and within their source, by ranges of positions."""
    whole = O.numbered_by_range(sparse(spark, sf_dir), ["place"], "no")
    return O.numbered_by_range(whole, ["place"], "source_no", ["source"]).select("pos", "no", "source_no")


@query("cap_sparse", X.with_sql(SPARSE, "SELECT source, pos FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY place) AS n FROM sparse) x WHERE n <= 20"))
def cap_sparse(spark, sf_dir):
    """The first 20 of each source by such positions."""
    return O.first_n_by_range(sparse(spark, sf_dir), ["source"], ["place"], 20).select("source", "pos")
