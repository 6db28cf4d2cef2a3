"""What the physical plans look like when nothing is small enough to broadcast."""

import re

from pyspark.sql import functions as F
import pytest

from articleflow.operators import incremental as I
from articleflow.operators import ordered as O
from articleflow.plans import QUERIES
from articleflow.plans import fixtures as X
from articleflow.sources import tables as T

SF = "/root/testdata/sf0.001"
STORED = "ReadSchema: struct<uid:string>"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tree(df):
    """Operator names with their depth."""
    out = []
    for line in plan(df).splitlines():
        m = re.match(r"^([\s:|+-]*)([A-Z]\w+)", line)
        if m:
            out.append((len(m[1]), m[2], line))
    return out


def test_no_query_multiplies_rows(spark, no_broadcast):
    eager = {
        "article_scan", "stream_ingest", "status_table", "digest_lines", "daily_digest", "site_listing", "index_antijoin", "index_load", "verdict_overlay",
        "digest_table", "evaluated_table", "batch_snapshot", "scored_once", "write_counters", "header_check",
    }
    for name in sorted(set(QUERIES) - eager):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_load_shuffles_wide_rows_once_and_limits_hot_keys_first(spark, no_broadcast):
    text = plan(QUERIES["incremental_load"](spark, SF))
    wide = [line for line in text.splitlines() if "FileScan" in line and "text#" in line.split("Batched")[0]]
    assert len(wide) == 1
    below = text[text.index("Exchange hashpartitioning(_dedupe_key"):]
    assert below.splitlines()[1].strip().startswith(("+- WindowGroupLimit", ":", "|")) and "Partial" in below.splitlines()[1]


def test_the_history_is_read_for_its_key_only(spark, no_broadcast, tmp_path):
    X.articles(spark, SF).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    text = plan(I.new_rows(X.articles(spark, SF), history, "pos"))
    assert len(re.findall(r"FileScan parquet \[uid#\d+\]", text)) == 1 and text.count(STORED) == 1


def test_a_small_batch_does_not_shuffle_the_history(spark, tmp_path):
    X.articles(spark, SF).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    batch = X.articles(spark, SF).select("pos", "uid")
    nodes = tree(I.new_rows(batch, history, "pos"))
    scan = next(i for i, n in enumerate(nodes) if re.search(r"FileScan parquet \[uid#\d+\]", n[2]))
    above = [n[1] for n in nodes[:scan] if n[0] < nodes[scan][0]]
    assert above.index("BroadcastHashJoin") >= 0
    between = above[len(above) - above[::-1].index("BroadcastHashJoin"):]
    assert "Exchange" not in between


def test_a_bucketed_history_is_not_shuffled(spark, no_broadcast, tmp_path):
    T.save_bucketed_history(X.articles(spark, SF), "history_by_uid", str(tmp_path / "b"), 4)
    try:
        nodes = tree(I.new_rows(X.articles(spark, SF), spark.table("history_by_uid"), "pos", stored=True))
        scan = next(i for i, n in enumerate(nodes) if "history_by_uid" in n[2])
        path = [n for i, n in enumerate(nodes[:scan]) if all(m[0] > n[0] for m in nodes[i + 1 : scan + 1])]
        names = [n[1] for n in path]
        join = len(names) - 1 - names[::-1].index("SortMergeJoin")
        assert "Exchange" not in names[join:]
    finally:
        spark.sql("DROP TABLE history_by_uid")


def test_scans_never_gather_a_key(spark, no_broadcast):
    """Rows are shuffled by key and chunk, or by key and salt, or by key after a limit."""
    df = X.listing(spark, SF)
    recent = F.col("published_on") >= F.lit("2024-01-28").cast("date")
    for out in (
        O.take_while(df, ["source"], "pos", recent), O.until_seen_streak(df, ["source"], "pos", recent),
        O.fill_down(df, ["source"], "pos", recent, F.col("title"), "t"), O.numbered(df, "pos", "n", ["source"]),
    ):
        text = plan(out)
        assert not re.search(r"Window \[[^\n]*\], \[source#\d+\], \[pos#", text)
        for line in text.splitlines():
            if re.search(r"Exchange hashpartitioning\(source#\d+, \d+\)", line):
                assert "pos#" not in line
    limited = plan(O.first_n(df, ["source"], "pos", 20))
    assert limited.count("WindowGroupLimit") == 4


def test_filters_and_columns_reach_the_scan(spark):
    e = X.table(spark, SF, "events").select(F.col("user_id"), F.col("event_id").alias("pos"), "event_type", "props")
    text = plan(O.take_while(e, ["user_id"], "pos", F.col("event_type") == "view").select("pos"))
    assert "props" not in text and "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in text


def test_python_runs_after_known_pages_left(spark, no_broadcast):
    text = plan(QUERIES["new_page_content"](spark, SF))
    assert text.index("MapInArrow") < text.index("LeftAnti")
