"""Stages of the pipeline with missing and repeated ids, clashing columns, and nothing."""

import random
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402

CLASHES = "doc_id long, row string, text string, lang string, no long, key long, n_chars int, score double, lang_pred string, n_words string, hit_runs string, kept_text string, fp long, id long"


def made(spark, rows):
    return spark.createDataFrame([(i, "r", t, la, 1, 2, 3, 0.5, "xx", "w", "h", "k", 4, 5) for i, t, la in rows], CLASHES)


def words(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_near_duplicates_keep_one_row_of_each_group(spark):
    rng = random.Random(8)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    rows = [(None, a, "en"), (None, a, "en"), (1, a, "en"), (2, b, "en"), (2, c, "en"), (3, b.upper(), "en"), (None, d, "en"), (None, d, "en"), (None, None, None), (7, "", None)]
    docs = made(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, a), (2, b), (2, c), (None, d), (7, "")], key=repr)


def test_stages_keep_clashing_columns_and_bear_nothing(spark, tmp_path):
    rng = random.Random(9)
    spark.createDataFrame([("b", words(rng, 12))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, " ".join(rng.choice("the and of river stone with from this that house".split()) for _ in range(40)), "en" if i % 2 else "de") for i in range(30)]
    docs = made(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        if name != "encoding":
            assert got.schema.names == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name
            assert got.select("row", "key", "score", "hit_runs").distinct().collect() == [("r", 2, 0.5, "h")], name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    nameless = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify(spark, nameless, "").count() == 30
    docs.select("doc_id", "text", "lang").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_text_queries_are_registered():
    assert __spark_entry__.TEXT_MISSING == ""
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in __spark_entry__.queries()}
