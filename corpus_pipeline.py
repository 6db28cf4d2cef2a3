"""From documents to token ids: language, near-duplicates, repeated passages, benchmark, encoding.

Each stage takes all rows that its predecessor kept, as Parquet in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.llm import bpe, decontaminate, language, repeats, simhash
from articleflow.session import configure, settle

# A text whose best language has less than this share of the margins is rejected.
MIN_LANGUAGE = 0.3


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that no name of theirs meets one of an operator's."""
    return docs.select("text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters (so null and empty ones) and undecided
    ones go. Where no document names a language there is nothing to learn, and all stay."""
    configure(spark)
    model = language.fit(docs)
    if model is None:
        return docs
    found = language.predict(_packed(docs), model, keep=["text", "row"])
    return _unpacked(found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE)), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: three-word shingles, fingerprints that differ in at most two
    bits, and what is linked by such pairs. The smallest id stays, a missing id is the last choice; rows have
    a key of their own, so null and repeated ids hide or remove nothing. Texts without words are alike."""
    configure(spark)
    rows = settle(_packed(docs).withColumn("no", F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc_id"), "no")
    found = simhash.near_duplicates(rows.select(order.alias("key"), "text"), doc_id="key")
    first = found.where(F.col("key") == F.col("component_id")).select(F.col("key.no").alias("no"))
    return _unpacked(rows.join(first, "no", "left_semi"), docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages; a null text becomes empty, equal rows lose what they share."""
    configure(spark)
    cut = repeats.remove_repeats(_packed(docs), keep=["row"]).withColumnRenamed("kept_text", "text")
    kept = _unpacked(cut, docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none and stay."""
    configure(spark)
    hits = decontaminate.benchmark_hits(_packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["text", "row"])
    return _unpacked(hits.where(F.size("hit_runs") == 0), docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids of each document and digests of its ids and decoded text; null and empty texts have no ids."""
    configure(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, vocabulary, bpe.build_lexicon(docs, vocabulary), keep=["doc_id"])


STAGES = [
    ("language", identify),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("benchmark", benchmark),
    ("encoding", encoding),
]
# Kernels, fingerprints and merges are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
