from datetime import date

from pyspark.sql import functions as F

from articleflow.operators import filters as P
from articleflow.operators import incremental as I
from articleflow.schema import ARTICLE_FIELDS

NOW = date(2024, 1, 31)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def batch(spark, data):
    return spark.createDataFrame(data, "pos bigint, uid string, url string")


def test_canonical_rows_have_all_columns(spark):
    df = spark.createDataFrame([(1, " a\tb ", "x\r\n\r\n\r\ny ", 5, "z")], "pos int, source string, content string, title int, extra string")
    row = I.canonicalize(df).first().asDict()
    assert list(row) == ARTICLE_FIELDS
    assert (row["source"], row["content"], row["title"], row["uid"]) == ("a b", "x\n\ny", "5", "")


def test_first_row_wins_and_empty_keys_stay(spark):
    b = batch(spark, [(3, "a", "u"), (1, "a", "v"), (2, "", "w"), (4, "", "w"), (5, None, "w"), (6, "b", "w")])
    assert rows(I.first_per_key(b, F.col("uid"), "pos"), "pos") == [(1,), (2,), (4,), (5,), (6,)]


def test_new_rows_by_uid_and_url(spark):
    b = batch(spark, [(1, "a", "u1"), (2, "b", "u2"), (3, "b", "u3"), (4, "", "u1"), (5, "c", "")])
    h = spark.createDataFrame([(" a ", "u2"), ("", "u3"), (None, None)], "uid string, url string")
    assert rows(I.new_rows(b, h, "pos"), "pos") == [(2,), (4,), (5,)]
    assert rows(I.new_rows(b, h, "pos", dedupe_by="url"), "pos") == [(1,), (5,)]
    assert I.new_rows(b, h, "pos", dedupe_by="title").count() == 5
    assert rows(I.not_in_history(b, h, "pos"), "pos") == [(2,), (3,), (4,), (5,)]
    assert rows(I.in_history(b, h, "pos"), "pos") == [(2,), (3,)]
    assert rows(I.mark_known(b, h, "url", "known"), "pos", "known") == [
        (1, False), (2, True), (3, True), (4, False), (5, False),
    ]


def test_history_keys_may_be_links_or_absent(spark):
    b = batch(spark, [(1, "a", "u1"), (2, "b", "u2")])
    links = spark.createDataFrame([("u1",)], "link string")
    assert rows(I.not_in_history(b, links, "pos", by="url"), "pos") == [(2,)]
    other = spark.createDataFrame([("x",)], "other string")
    assert I.not_in_history(b, other, "pos").count() == 2


def test_a_hot_key_loses_nothing(spark):
    b = spark.range(20000).select(
        F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("uid"),
        F.lit("u").alias("url"),
    ).repartition(4)
    h = spark.range(5000).select(F.col("id").cast("string").alias("uid"))
    got = I.new_rows(b, h, "pos")
    want = {0} | {i for i in range(5000, 20000) if i % 3}
    assert {r["pos"] for r in got.select("pos").collect()} == want


def test_union_keeps_job_order(spark):
    a, b = batch(spark, [(9, "x", "1"), (8, "y", "2")]), batch(spark, [(1, "x", "3"), (2, "z", "4")])
    u = I.union_sources([("a", a), ("b", b.drop("url"))])
    assert rows(I.first_per_key(u, F.col("uid"), "batch_pos"), "source_order", "pos", "uid") == [(0, 8, "y"), (0, 9, "x"), (1, 2, "z")]


def test_write_back(spark):
    h = spark.createDataFrame([("a", "1", "x"), ("b", "1", None), ("b", "1", "y"), ("d", "1", "z")], "uid string, k string, v string")
    b = spark.createDataFrame([("a", "n", 1), ("a", None, 2), ("b", "m", 5), ("b", "l", 4), ("e", "q", 1)], "uid string, v string, pos int")
    assert rows(I.write_back(h, b, "pos", ["v"]), "uid", "k", "v") == [("a", "1", "x"), ("b", "1", "m"), ("b", "1", "m"), ("d", "1", "z")]


def test_backfill(spark):
    h = spark.createDataFrame([("u1", "", ""), ("u2", "abs", None), ("u3", "", "full"), ("", "", "")], "url string, abstract string, content string")
    listed = spark.createDataFrame([(5, "u2"), (1, "u3"), (2, "u9"), (7, "u1"), (8, "")], "pos int, url string")
    assert [r["url"] for r in I.backfill_candidates(listed, h, "pos").collect()] == ["u2", "u1"]
    assert [r["url"] for r in I.backfill_candidates(listed, h, "pos", limit=1).collect()] == ["u2"]
    u = spark.createDataFrame([(2, "u1", "B", "second"), (1, "u1", "A", "first"), (3, "u3", "A", "no"), (4, "", "A", "no")], "pos int, url string, abstract string, content string")
    assert rows(I.apply_backfill(h, u, "pos"), "url", "abstract", "content") == [
        ("", "", ""), ("u1", "A", "first"), ("u2", "abs", ""), ("u3", "A", "full"),
    ]


def test_columns_are_aligned_not_reset(spark):
    df = spark.createDataFrame([("a", None, 1)], "uid string, title string, extra int")
    row = I.align_columns(df).first().asDict()
    assert (row["uid"], row["title"], row["m2_reason"]) == ("a", "", "") and "extra" not in row


def test_window_has_only_a_lower_bound(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 29)), (2, date(2024, 1, 30)), (3, date(2025, 1, 1)), (4, None)], "pos int, published_on date")
    assert rows(P.lookback(df, NOW), "pos") == [(2,), (3,)]
    assert rows(P.lookback(df, NOW, days=2), "pos") == [(1,), (2,), (3,)]


def test_undated_policies(spark):
    data = [(i, d, p) for i, (d, p) in enumerate(
        [(None, "drop"), (None, "today"), (None, "keep_raw"), (date(2024, 1, 1), "today"), (date(2024, 1, 1), "keep_raw"), (NOW, "drop")]
    )]
    df = spark.createDataFrame(data, "pos int, published_on date, on_unparsed string")
    assert rows(P.apply_undated_policy(df, NOW), "pos", "published_on") == [(1, NOW), (2, None), (5, NOW)]


def test_skipped_links(spark):
    df = spark.createDataFrame(
        [(1, "a.PDF", "t"), (2, "a.pdf.html", "t"), (3, "a", "The Annexes"), (4, "a", "Stable"), (5, "a.zip", None), (6, "a", None)],
        "pos int, url string, title string",
    )
    assert rows(P.skip_links(df), "pos") == [(2,), (6,)]


def test_source_selection(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "source string")
    assert rows(P.select_sources(df, ["a", "b", "x"], ["b"]), "source") == [("a",)]
    assert P.select_sources(df).count() == 3
    assert rows(P.select_sources(df, skip=["a"]), "source") == [("b",), ("c",)]


def test_missing_content(spark):
    df = spark.createDataFrame([("u", None), ("u", ""), ("", ""), ("u", "x")], "url string, content string")
    assert P.missing_content(df).count() == 2


def test_fallbacks(spark):
    df = spark.createDataFrame(
        [("abstract", "", " a ", "t"), ("abstract_title", None, "", "t"), ("title", "", "a", "t"), ("", "", "a", "t"), ("title", "c", "a", "t")],
        "chain string, content string, abstract string, title string",
    ).coalesce(1)
    c = F.col
    got = df.select(P.content_fallback(c("chain"), c("content"), c("abstract"), c("title")).alias("x")).collect()
    assert [r["x"] for r in got] == ["a", "t", "t", "", "c"]
    modes = spark.createDataFrame([("listing",), ("prefix300",), ("empty",)], "mode string").coalesce(1)
    cut = modes.select(P.derived_abstract(c("mode"), F.lit(" a  b "), F.lit(" " * 299 + "xy")).alias("x")).collect()
    assert [r["x"] for r in cut] == ["a b", "x", ""]


def test_pending_runs(spark):
    asked = spark.createDataFrame([("d1",), ("d2",)], "run_date string")
    done = spark.createDataFrame([("d1", "l"), ("d1", "m")], "run_date string, line string")
    assert rows(I.pending_runs(asked, done), "run_date") == [("d2",)]


def test_hot_keys_are_spread(spark):
    """A key with a third of the rows does not meet in one task, and others are not repeated."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    few = rows.select("k").distinct().withColumn("v", F.lit(1))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        joined = I.spread_join(rows, few, ["k"], "left", hot_rows=1000)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 30_000 and joined.filter("v is null").count() == 0
        assert max(r["count"] for r in sizes) < 7000
        assert I.spread_join(rows, few.filter("k = 0"), ["k"], "left_anti", hot_rows=1000).count() == 20_000
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_only_the_prompt_at_fault_has_no_answer(spark):
    from articleflow.operators.scoring import score

    def picky(prompts):
        if any(p == "77" for p in prompts):
            raise ValueError("77")
        return list(prompts)

    df = spark.range(500).select("id", F.col("id").cast("string").alias("prompt"))
    got = score(df.coalesce(1), {"a": picky}).collect()
    assert [r.id for r in got if r.a_raw is None] == [77] and len(got) == 500
