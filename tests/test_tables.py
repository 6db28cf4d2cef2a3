from datetime import date

from pyspark.sql import functions as F
import pytest

from articleflow.functions.text import make_uid
from articleflow.operators import incremental as I
from articleflow.schema import ARTICLE_FIELDS, VERDICT_FIELDS
from articleflow.session import settle, work_dir
from articleflow.sources import articles as A
from articleflow.sources import tables as T
from articleflow.streaming.ingest import ingest, load_batch

NOW = date(2024, 1, 31)


def collected(spark, first, last):
    df = spark.range(first, last).select(
        F.col("id").alias("pos"), F.lit("s").alias("source"), F.concat(F.lit("https://x/"), (F.col("id") % 40).cast("string")).alias("url"),
        F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"), F.lit("line\r\n\r\n\r\nline").alias("content"),
        F.date_sub(F.lit(NOW), (F.col("id") % 3).cast("int")).alias("published_on"),
    )
    return df.withColumns({"uid": make_uid(F.col("source"), F.col("url")), "published_at": F.col("published_on").cast("string")})


def test_csv_round_trip_with_bom_quotes_and_line_breaks(spark, tmp_path):
    header = ",".join(f'"{c}"' for c in ARTICLE_FIELDS)
    values = ["u", "s", "", "c", "2024", 'a "quoted", title', "http://x", "line one\nline two", "", "html", "t", ""]
    record = ",".join('"' + v.replace('"', '""') + '"' for v in values)
    (tmp_path / "a.csv").write_bytes(f"{header}\r\n{record}\r\n".encode("utf-8-sig"))
    assert [list(r) for r in A.read_articles(spark, str(tmp_path)).collect()] == [values]


def test_ragged_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"a","b"\n"1","x\ny"\n"2"\n"3","y","z"\n"4","ok"\n')
    row = A.validate_articles(spark, str(tmp_path), ["a", "b"]).first()
    assert (row["rows"], row["malformed"], row["empty_values"]) == (4, 2, 0) and row["example"].startswith('"2"')


def test_corpus(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"title": "a", "entity": null},\n {"content": "x", "url": "u", "entity": "E"}]')
    got = sorted(tuple(r) for r in A.read_corpus(spark, str(tmp_path)).select("title", "abstract", "content", "url", "entity").collect())
    assert got == [("", "", "x", "u", "E"), ("a", "", "", "", "Source")]


def test_column_fill(spark):
    df = spark.createDataFrame([("a", ""), (None, "b"), ("", "c")], "x string, y string")
    assert {r["name"]: r["empty"] for r in A.column_fill(df).collect()} == {"x": 2, "y": 1}


@pytest.mark.parametrize("suffix", ["json", "csv", "parquet"])
def test_evaluated_output(spark, tmp_path, suffix):
    df = spark.createDataFrame([("t\nu", 'say "x"', "TRUE")], "title string, m1_reason string, is_relevant string")
    path = str(tmp_path / f"out.{suffix}")
    T.write_evaluated(df, path)
    reader = spark.read.schema(df.schema)
    back = {"json": reader.json, "parquet": reader.parquet}.get(
        suffix, reader.option("header", True).option("multiLine", True).option("escape", '"').csv
    )(path)
    assert [tuple(r) for r in back.collect()] == [("t\nu", 'say "x"', "TRUE")]


@pytest.mark.parametrize("load_ids", [None, [1]])
def test_loads_are_idempotent_and_write_back_touches_its_loads(spark, tmp_path, load_ids):
    path = str(tmp_path / "history")
    T.create_history(spark, path)
    for load_id, (lo, hi) in enumerate([(0, 30), (20, 60)]):
        for _ in range(2):
            history = T.read_history(spark, path).filter(F.col("load_id") < load_id)
            T.write_load(load_batch(collected(spark, lo, hi), history, NOW, "pos"), path, load_id)
    history = T.read_history(spark, path)
    assert history.count() == history.select("uid").distinct().count() == 40 - sum(1 for i in range(40) if all(j % 3 == 2 for j in (i, i + 40) if j < 60))
    again = load_batch(collected(spark, 0, 60), history, NOW, "pos")
    assert again.count() == 0

    def files(load_id):
        return sorted(p.name for p in (tmp_path / "history" / "run_id=loads" / f"load_id={load_id}").glob("*.parquet"))

    first, second, stored = files(0), files(1), history.count()
    newest = history.filter("load_id = 1").select("uid", F.lit(1).alias("pos"), *[F.lit("TRUE").alias(c) for c in VERDICT_FIELDS])
    T.write_back_history(spark, path, newest, "pos", load_ids)
    assert files(0) == first and files(1) != second
    after = T.read_history(spark, path)
    assert after.count() == stored
    assert after.filter("is_relevant = 'TRUE' and m2_reason = 'TRUE'").count() == after.filter("load_id = 1").count() > 0


def test_batch_and_digest_tables_replace_a_run_date(spark, tmp_path):
    rows = I.canonicalize(collected(spark, 0, 5))
    for _ in range(2):
        T.write_batch(rows, str(tmp_path / "batch"), "2024-01-31")
        T.write_digest(spark.createDataFrame([(1, 1, "x")], "item_no int, line_no int, line string"), str(tmp_path / "digest"), "2024-01-31")
    T.write_batch(rows, str(tmp_path / "batch"), "2024-02-01")
    assert spark.read.parquet(str(tmp_path / "batch")).count() == 10
    assert spark.read.parquet(str(tmp_path / "digest")).count() == 1


def test_stream_equals_batches_and_replays_are_no_ops(spark, tmp_path):
    landing, path = str(tmp_path / "in"), str(tmp_path / "history")
    collected(spark, 0, 30).coalesce(1).write.mode("append").parquet(landing)
    collected(spark, 20, 60).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        ingest(stream, path, str(tmp_path / "cp"), "pos", lambda batch_id: NOW).awaitTermination()
    stored = T.read_history(spark, path)
    whole = load_batch(collected(spark, 0, 30).union(collected(spark, 20, 60)), stored.limit(0), NOW, "pos")
    assert stored.select("load_id").distinct().count() == 2
    assert sorted(r["uid"] for r in stored.collect()) == sorted(r["uid"] for r in whole.collect())
    # A lost checkpoint is a new run: it finds everything known and changes nothing.
    before = sorted(tuple(r) for r in stored.select("uid", "run_id", "load_id").collect())
    replay = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    ingest(replay, path, str(tmp_path / "cp2"), "pos", lambda batch_id: NOW).awaitTermination()
    assert sorted(tuple(r) for r in T.read_history(spark, path).select("uid", "run_id", "load_id").collect()) == before


def test_stream_keeps_what_other_loads_stored(spark, tmp_path):
    landing, path = str(tmp_path / "in"), str(tmp_path / "history")
    for load_id, (lo, hi) in ((0, (0, 10)), (42, (10, 20))):
        T.write_load(I.canonicalize(collected(spark, lo, hi)), path, load_id)
    collected(spark, 15, 30).coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    ingest(stream, path, str(tmp_path / "cp"), "pos", lambda batch_id: NOW).awaitTermination()
    stored = T.read_history(spark, path)
    assert stored.filter("run_id = 'loads'").count() == 20
    uids = [r.uid for r in stored.collect()]
    assert len(uids) == len(set(uids)) == 20 + sum(1 for i in range(20, 30) if i % 3 < 2)


def test_an_empty_rerun_leaves_nothing(spark, tmp_path):
    rows = I.canonicalize(collected(spark, 0, 5))
    for n, part in ((5, rows), (0, rows.limit(0))):
        T.write_load(part, str(tmp_path / "history"), 7)
        T.write_batch(part, str(tmp_path / "batch"), "2024-01-31")
        T.write_digest(part.select("title"), str(tmp_path / "digest"), "2024-01-31")
        counts = [T.read_history(spark, str(tmp_path / "history")).count(), spark.read.parquet(str(tmp_path / "batch")).count(), spark.read.parquet(str(tmp_path / "digest")).count()]
        assert counts == [n, n, n]


def test_stored_backfill_touches_loads_with_gaps_only(spark, tmp_path):
    path = str(tmp_path / "history")
    for load_id in (0, 1):
        rows = I.canonicalize(collected(spark, 10 * load_id, 10 * load_id + 10))
        T.write_load(rows.withColumn("content", F.when(F.col("url").endswith("/12"), "").otherwise(F.col("content"))), path, load_id)
    updates = spark.createDataFrame([("https://x/12", "a", "new", 1), ("https://x/3", "a", "other", 2)], "url string, abstract string, content string, pos int")
    T.backfill_history(spark, path, updates.filter("pos = 1"), "pos")
    got = {r.url: r.content for r in T.read_history(spark, path).collect()}
    assert len(got) == 20 and got["https://x/12"] == "new" and got["https://x/3"] != "other"


def test_results_settle_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(f"{shared}/x-") and work_dir(spark, "x") != work_dir(spark, "x")
    stored = settle(spark.range(3).toDF("id"), "y")
    assert stored.count() == 3 and all(shared in f for f in stored.inputFiles())
