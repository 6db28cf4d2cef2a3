"""Snapshot tables, the indexed history and verdicts laid over it."""

from datetime import date

from pyspark.sql import functions as F
import pytest

from articleflow.functions.text import make_uid
from articleflow.operators import incremental as I
from articleflow.schema import ARTICLE_FIELDS, VERDICT_FIELDS
from articleflow.sources import history as H
from articleflow.sources import snapshots as S
from articleflow.sources import tables as T
from articleflow.streaming.ingest import ingest, load_batch

NOW = date(2024, 1, 31)


def collected(spark, first, last, urls=10_000):
    df = spark.range(first, last).select(
        F.col("id").alias("pos"), F.lit("s").alias("source"), F.concat(F.lit("https://x/"), (F.col("id") % urls).cast("string")).alias("url"),
        F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"), F.lit("text").alias("content"), F.lit(NOW).alias("published_on"),
    )
    return df.withColumns({"uid": make_uid(F.col("source"), F.col("url")), "published_at": F.col("published_on").cast("string")})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_broken_write_leaves_the_former_content(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert S.live(spark, path) == {} and S.version(spark, path) == 0
    assert S.read(spark, path, "batch", T.BATCH).count() == 0
    T.publish_batch(I.canonicalize(collected(spark, 0, 5)), path, "2024-01-31")
    before = rows(T.read_batches(spark, path))
    # Killed while writing: rows are there that no commit names; killed while staging: an error on the way.
    S.stage(I.align_columns(collected(spark, 0, 9)).withColumn("run_date", F.lit("2024-01-31")), path, "batch")
    broken = I.canonicalize(collected(spark, 0, 9)).withColumn("title", F.expr("if(title > '', raise_error('x'), '')"))
    with pytest.raises(Exception, match="x"):
        T.publish_batch(broken, path, "2024-01-31")
    monkeypatch.setattr(S, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        S.publish(I.canonicalize(collected(spark, 0, 9)), path, "batch/2024-01-31")
    assert rows(T.read_batches(spark, path)) == before and len(before) == 5


def test_slots_are_replaced_as_a_whole_and_old_folders_go(spark, tmp_path):
    path = str(tmp_path / "t")
    lines = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "item_no int, line_no int, line string")
    for _ in range(3):
        T.publish_digest(lines, path, "2024-01-31")
    T.publish_digest(lines.limit(1), path, "2024-02-01")
    assert T.read_digest(spark, path, "2024-01-31").count() == 2 and T.read_digest(spark, path, "2024-02-01").count() == 1
    assert len(list((tmp_path / "t" / "data" / "digest").iterdir())) == 4
    assert S.vacuum(spark, path) == 2 and S.vacuum(spark, path) == 0
    assert T.read_digest(spark, path, "2024-01-31").count() == 2
    T.publish_digest(lines.limit(0), path, "2024-01-31")
    assert T.read_digest(spark, path, "2024-01-31").count() == 0


def test_a_load_and_its_keys_appear_together(spark, tmp_path):
    path = str(tmp_path / "h")
    H.write_load(collected(spark, 0, 50), path, 0)
    seen = S.version(spark, path)
    H.write_load(collected(spark, 50, 80).withColumn("url", F.when(F.col("pos") < 60, F.col("url")).otherwise(F.lit(" "))), path, 1)
    assert S.version(spark, path) == seen + 1
    assert rows(H.read_index(spark, path).select("uid", "load_id")) == rows(H.read_loads(spark, path).select("uid", "load_id"))
    assert H.read_index(spark, path, "url").count() == 60
    before = rows(H.read_index(spark, path))
    for step in (H.compact_index, H.rebuild_index, H.compact_index):
        step(spark, path)
        assert rows(H.read_index(spark, path)) == before
    assert len(S.live(spark, path, "index_uid/")) == 1


def test_lookups_equal_those_in_the_history(spark, tmp_path):
    path = str(tmp_path / "h")
    for load_id, (lo, hi) in enumerate([(0, 40), (40, 70)]):
        H.write_load(collected(spark, lo, hi), path, load_id)
    batch = collected(spark, 30, 120, urls=100).withColumn("uid", F.when(F.col("pos") % 9 == 0, F.lit("")).otherwise(F.col("uid")))
    loads = H.read_loads(spark, path)
    for compacted in (False, True):
        if compacted:
            H.compact_index(spark, path)
        for by in ("uid", "url"):
            index = H.read_index(spark, path, by)
            assert rows(I.not_in_history(batch, index, "pos", by)) == rows(I.not_in_history(batch, loads, "pos", by))
            assert rows(I.in_history(batch, index, "pos", by)) == rows(I.in_history(batch, loads, "pos", by))
            assert rows(I.new_rows(batch, index, "pos", by, stored=True)) == rows(I.new_rows(batch, loads, "pos", by))


def test_a_load_published_again_counts_by_its_new_keys(spark, tmp_path):
    path = str(tmp_path / "h")
    H.write_load(collected(spark, 0, 20), path, 0)
    H.write_load(collected(spark, 20, 30), path, 1)
    H.compact_index(spark, path)
    H.write_load(collected(spark, 0, 5), path, 0)
    assert H.read_index(spark, path).count() == 15
    H.drop_load(spark, path, 1)
    assert rows(H.read_index(spark, path).select("uid")) == rows(H.read_loads(spark, path).select("uid")) and H.read_loads(spark, path).count() == 5
    H.compact_index(spark, path)
    assert H.read_index(spark, path).count() == 5


def test_a_small_batch_reads_its_prefixes_only(spark, tmp_path):
    path = str(tmp_path / "h")
    H.write_load(collected(spark, 0, 400), path, 0)
    one = collected(spark, 7, 8).select("pos", "uid").persist()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = I._known(I.with_key(one, F.col("uid"), "pos"), H.read_index(spark, path), "uid", True)
        plan = found._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString() and found.count() == 1
        assert found.collect() and "dynamicpruning" in plan.toString()
        leaves = plan.collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString() or "Scan parquet" in leaves.apply(i).nodeName()]
        read = [s.metrics().apply("numPartitions").value() for s in scans if s.metrics().contains("numPartitions")]
        assert read == [1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        one.unpersist()


def judged(spark, spec):
    """Batch rows (pos, uid number, label); a null label leaves what was there."""
    made = spark.createDataFrame(spec, "pos long, n long, is_relevant string")
    uid = make_uid(F.lit("s"), F.concat(F.lit("https://x/"), F.col("n").cast("string")))
    return made.select("pos", F.when(F.col("n") >= 0, uid).otherwise("").alias("uid"), "is_relevant", *[F.concat(F.lit(f"{c} "), F.col("pos").cast("string")).alias(c) for c in VERDICT_FIELDS[1:]])


def test_verdicts_laid_over_equal_verdicts_written_back(spark, tmp_path):
    path, plain = str(tmp_path / "h"), str(tmp_path / "plain")
    T.create_history(spark, plain)
    for load_id, (lo, hi) in enumerate([(0, 10), (10, 20), (20, 30)]):
        H.write_load(collected(spark, lo, hi), path, load_id)
        T.write_load(collected(spark, lo, hi), plain, load_id)
    batches = [[(1, 3, "TRUE"), (2, 3, "FALSE"), (3, 12, None), (4, -1, "TRUE")], [(5, 3, None), (6, 4, "TRUE"), (7, 999, "TRUE")], [(8, 12, "ERROR")]]
    for delta, spec in enumerate(batches):
        for _ in range(2):  # a replay
            H.write_verdicts(judged(spark, spec), path, delta, "pos")
        T.write_back_history(spark, plain, judged(spark, spec).filter("uid <> ''"), "pos")
        assert rows(H.read_history(spark, path)) == rows(T.read_history(spark, plain))
    untouched = S.live(spark, path, "loads/")["loads/loads/2"]
    before = rows(H.read_history(spark, path))
    H.compact_verdicts(spark, path)
    assert rows(H.read_history(spark, path)) == before == rows(H.read_loads(spark, path))
    assert S.live(spark, path, "verdicts/") == {} and S.live(spark, path, "loads/")["loads/loads/2"] == untouched
    H.compact_verdicts(spark, path)
    H.write_verdicts(judged(spark, [(9, 25, "TRUE")]), path, 9, "pos")
    assert H.read_history(spark, path).filter("is_relevant = 'TRUE'").count() == 2
    assert rows(H.read_index(spark, path).select("uid")) == rows(H.read_loads(spark, path).select("uid"))


def test_an_indexed_stream_equals_a_plain_one(spark, tmp_path):
    landing, path = str(tmp_path / "in"), str(tmp_path / "history")
    collected(spark, 0, 30, urls=25).coalesce(1).write.mode("append").parquet(landing)
    collected(spark, 20, 60, urls=50).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    H.write_load(collected(spark, 40, 45), path, 0)
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        ingest(stream, path, str(tmp_path / "cp"), "pos", lambda batch_id: NOW, indexed=True).awaitTermination()
    stored = H.read_loads(spark, path)
    whole = load_batch(collected(spark, 0, 30, urls=25).union(collected(spark, 20, 60, urls=50)), collected(spark, 40, 45), NOW, "pos")
    assert sorted(r.uid for r in stored.filter("run_id <> 'loads'").collect()) == sorted(r.uid for r in whole.collect())
    assert rows(H.read_index(spark, path).select("uid")) == rows(stored.select("uid"))


def test_an_older_history_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "h")
    H.import_history(I.canonicalize(collected(spark, 0, 7)).select(*ARTICLE_FIELDS[:8]), path)
    assert H.read_index(spark, path).count() == 7 and H.read_history(spark, path).filter("run_id = 'imported' and content = ''").count() == 7


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_spread_joins_lose_nothing(spark, threshold):
    hot = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    few = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            assert rows(I.spread_join(hot, few, ["k"], how, hot_rows=100)) == rows(hot.join(few, "k", how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
