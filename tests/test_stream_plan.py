"""The registered stream over tables with missing ids and over an empty one."""

from pathlib import Path

from pyspark.sql import functions as F

from articleflow.plans import QUERIES
from articleflow.plans import incremental as P

SF = "/root/testdata/sf0.001"


def test_stream_takes_every_row_once(spark, tmp_path, monkeypatch):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    extra = documents.limit(5).withColumn("doc_id", F.lit(None).cast(documents.schema["doc_id"].dataType))
    monkeypatch.setattr(P, "work_dir", lambda spark, name: str(tmp_path / name))
    documents.union(extra).repartition(4).write.parquet(str(tmp_path / "with" / "documents.parquet"))
    QUERIES["stream_ingest"](spark, str(tmp_path / "with"))
    landed = tmp_path / "stream-ingest" / "landing"
    assert spark.read.parquet(str(landed)).count() == documents.count() + 5
    assert len(list(Path(landed).glob("*.parquet"))) > 3


def test_stream_of_nothing(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["stream_ingest"](spark, str(tmp_path)).count() == 0
