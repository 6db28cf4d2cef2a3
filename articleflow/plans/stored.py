"""Queries over tables that are written and read back: indexed history, verdicts laid over, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from articleflow.operators import incremental as I
from articleflow.operators import report
from articleflow.plans import fixtures as X
from articleflow.plans import verdicts as V
from articleflow.plans.incremental import RECENT_NEW, canonical_sql
from articleflow.plans.registry import ORACLES, query
from articleflow.schema import ARTICLE_FIELDS, VERDICT_FIELDS
from articleflow.session import settle, work_dir
from articleflow.sources import articles as A
from articleflow.sources import history as H
from articleflow.sources import snapshots, tables
from articleflow.streaming.ingest import load_batch


def stored_history(spark, sf_dir, name):
    """The history in two loads, the first of them published twice."""
    path = work_dir(spark, name)
    h = X.history(spark, sf_dir)
    half = F.col("pos") % 2 == 0
    H.write_load(h.filter(~half), path, 1)
    H.write_load(h.filter(half), path, 1)
    H.write_load(h.filter(~half | F.col("pos").isNull()), path, 2)
    return path


@query("index_antijoin", ORACLES["antijoin_uid"])
def index_antijoin(spark, sf_dir):
    """Articles whose uid no load stored, looked up in the index; half of it merged, half as written."""
    path = stored_history(spark, sf_dir, "index-antijoin")
    H.compact_index(spark, path)
    H.write_load(H.read_loads(spark, path, load_ids=[2]), path, 2, tables.LOADS)
    return I.not_in_history(X.articles(spark, sf_dir), H.read_index(spark, path), "pos").select("pos", "uid")


@query("index_load", X.with_sql(RECENT_NEW, canonical_sql("fresh").replace("SELECT pos, ", "SELECT ", 1)))
def index_load(spark, sf_dir):
    """The incremental load against the index; what it adds is read back, and a second run adds nothing."""
    path = stored_history(spark, sf_dir, "index-load")
    for _ in range(2):
        fresh = load_batch(X.articles(spark, sf_dir), H.read_index(spark, path).filter("load_id < 3"), X.NOW, "pos", stored=True)
        H.write_load(fresh, path, 3)
    again = load_batch(X.articles(spark, sf_dir), H.read_index(spark, path), X.NOW, "pos", stored=True)
    H.write_load(again, path, 4)
    return H.read_loads(spark, path).filter("load_id > 2").select(*ARTICLE_FIELDS)


@query("verdict_overlay", ORACLES["history_writeback"].replace("h.pos, h.uid", "h.uid").replace("FROM history h", "FROM history h", 1))
def verdict_overlay(spark, sf_dir):
    """Verdicts stored as changes and laid over the history; some merged into it, one batch replayed."""
    path = work_dir(spark, "verdict-overlay")
    h = X.history(spark, sf_dir).withColumn("is_relevant", F.lit("OLD"))
    H.write_load(h.filter("pos % 3 = 0"), path, 0)
    H.write_load(h.filter("pos % 3 <> 0 or pos is null"), path, 1)
    a = X.articles(spark, sf_dir).filter(F.col("published_on") >= F.lit("2024-01-10").cast("date"))
    m = F.col("pos") % 4
    judged = a.select(
        "pos", "uid", F.when(m == 1, F.lit("TRUE")).when(m > 1, F.lit("FALSE")).alias("is_relevant"), F.lit("True").alias("m1_is_relevant"),
        F.concat(F.lit("from "), F.col("pos").cast("string")).alias("m1_reason"), F.lit("None").alias("m2_is_relevant"), F.lit("Parse Error").alias("m2_reason"),
    )
    part = F.pmod(F.xxhash64("uid"), F.lit(3))
    for delta in (0, 1, 0):
        H.write_verdicts(judged.filter(part == delta), path, delta, "pos")
    H.compact_verdicts(spark, path)
    H.write_verdicts(judged.filter(part == 2), path, 2, "pos")
    return H.read_history(spark, path).select("uid", *VERDICT_FIELDS)


@query("digest_table", ORACLES["digest_lines"])
def digest_table(spark, sf_dir):
    """The digest of a run date published, read back; a broken second write and a replay change nothing."""
    path = work_dir(spark, "digest-table")
    judged = settle(V.judged(spark, sf_dir).select("pos", "label", "title_out", "summary", "entity", "url"), "judged")
    lines = report.digest_lines(judged, "pos")
    tables.publish_digest(lines.limit(1), path, "2024-01-31")
    for _ in range(2):
        tables.publish_digest(lines, path, "2024-01-31")
    tables.publish_digest(lines.filter("item_no = 1"), path, "2024-02-01")
    snapshots.stage(lines.limit(3), path, "digest")
    return tables.read_digest(spark, path, "2024-01-31")


@query("evaluated_table", ORACLES["evaluated_rows"])
def evaluated_table(spark, sf_dir):
    """Evaluated rows as JSON, CSV and Parquet, each read back by the suffix; a third of the rows from each."""
    rows = settle(V.evaluated_rows(spark, sf_dir), "evaluated")
    part = F.pmod(F.xxhash64("url", "content"), F.lit(3))
    root, back = work_dir(spark, "evaluated-table"), []
    for k, suffix in enumerate((".json", ".csv", "")):
        tables.write_evaluated(rows.filter(part == k), f"{root}/rows{suffix}")
        back.append(tables.read_evaluated(spark, f"{root}/rows{suffix}", rows.schema))
    return back[0].unionByName(back[1]).unionByName(back[2])


@query("batch_snapshot", X.with_sql(RECENT_NEW, canonical_sql("fresh").replace("SELECT pos, ", "SELECT ", 1)))
def batch_snapshot(spark, sf_dir):
    """The new batch of a run date as a snapshot, replaced by a second run; the other date stays."""
    path = work_dir(spark, "batch-snapshot")
    rows = settle(load_batch(X.articles(spark, sf_dir), X.history(spark, sf_dir), X.NOW, "pos"), "fresh")
    tables.publish_batch(rows, path, "2024-01-30")
    tables.publish_batch(rows.filter("pos % 2 = 0"), path, "2024-01-31")
    tables.publish_batch(rows, path, "2024-01-31")
    tables.publish_batch(rows.limit(0), path, "2024-01-30")
    return tables.read_batches(spark, path).select(*ARTICLE_FIELDS)


@query(
    "write_counters",
    X.with_sql(
        X.STAGED,
        """
        SELECT count(*) AS rows, count(*) FILTER (WHERE pos % 7 IN (3, 5)) AS malformed, min(pos) FILTER (WHERE pos % 7 IN (3, 5)) AS first_bad,
               count(*) FILTER (WHERE title = '' AND pos % 7 NOT IN (3, 5)) AS untitled, count(*) FILTER (WHERE pos % 7 NOT IN (3, 5)) AS stored FROM staged""",
    ),
)
def write_counters(spark, sf_dir):
    """CSV records of three columns, some with one less or more, counted on their way into the table."""

    m = F.col("pos") % 7
    fields = F.when(m == 3, F.array("source", "content")).when(m == 5, F.array("source", "title", "content", "url")).otherwise(F.array("source", "title", "content"))
    quoted_fields = F.transform(fields, lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"')))
    lines = X.staged(spark, sf_dir).select("pos", F.array_join(quoted_fields, ",").alias("line"))
    path = work_dir(spark, "write-counters")
    records = A.parse_lines(lines, "line", ["source", "title", "content"])
    bad = F.col(A.BAD).isNotNull()
    counts = tables.write_counted(
        records, lambda df: tables.publish_batch(df.filter(~bad), path, "2024-01-31"),
        rows=F.count(F.lit(1)), malformed=F.count(F.when(bad, 1)), first_bad=F.min(F.when(bad, F.col("pos"))), untitled=F.count(F.when(~bad & (F.coalesce("title", F.lit("")) == ""), 1)),
    )
    named = [F.lit(v).cast("long").alias(k) for k, v in counts.items()]
    return tables.read_batches(spark, path).agg(F.count("*").alias("stored")).select(*named, "stored")
