"""Articles, listings and model answers derived from the given tables.

Every frame has an SQL twin, used as a common table expression by the oracles.
The clock is fixed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.functions.text import make_uid

NOW = date(2024, 1, 31)
HISTORY_BEFORE = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_staged(table(spark, sf_dir, "documents"))


def as_staged(d: DataFrame) -> DataFrame:
    """Documents as collected articles; some links repeat."""
    url = F.concat(
        F.lit("https://"), "source", F.lit(".example.com/"), "lang", F.lit("/"),
        (F.col("doc_id") % 700).cast("string"),
    )
    return d.select(
        F.col("doc_id").alias("pos"), "source", F.upper("source").alias("entity"),
        F.col("lang").alias("category"),
        day("2024-01-01", (F.col("doc_id") * 7) % 30).alias("published_on"),
        F.substring("text", 1, 60).alias("title"), url.alias("url"),
        F.substring("text", 1, 300).alias("abstract"), F.col("text").alias("content"),
    )


STAGED = """
staged AS (
  SELECT doc_id AS pos, source, upper(source) AS entity, lang AS category,
         DATE '2024-01-01' + CAST((doc_id * 7) % 30 AS INT) AS published_on,
         substring(text, 1, 60) AS title,
         'https://' || source || '.example.com/' || lang || '/' || CAST(doc_id % 700 AS VARCHAR) AS url,
         substring(text, 1, 300) AS abstract, text AS content
  FROM documents)"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_articles(table(spark, sf_dir, "documents"))


def as_articles(d: DataFrame) -> DataFrame:
    return as_staged(d).withColumns(
        {
            "uid": make_uid(F.col("source"), F.col("url")),
            "published_at": F.col("published_on").cast("string"),
        }
    )


ARTICLES = STAGED + """,
articles AS (
  SELECT *, sha256(source || '|' || url) AS uid, CAST(published_on AS VARCHAR) AS published_at
  FROM staged),
history AS (SELECT * FROM articles WHERE published_on < DATE '2024-01-16')"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What earlier runs stored: the articles dated before the middle of the month."""
    return articles(spark, sf_dir).filter(F.col("published_on") < F.lit(HISTORY_BEFORE).cast("date"))


def gappy_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history with every fifth content missing."""
    return history(spark, sf_dir).withColumn(
        "content", F.when(F.col("pos") % 5 == 0, F.lit("")).otherwise(F.col("content"))
    )


GAPPY = ARTICLES + """,
gappy AS (
  SELECT * REPLACE (CASE WHEN pos % 5 = 0 THEN '' ELSE content END AS content) FROM history)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages: newest first per source, with some old items out of order."""
    old = F.when(F.col("pos") % 17 == 16, F.lit(40)).otherwise(F.lit(0))
    s = staged(spark, sf_dir)
    return s.select(
        "source", "pos", "url", "title",
        F.date_sub(
            F.lit("2024-01-31").cast("date"), (F.floor(F.col("pos") / 200) + old).cast("int")
        ).alias("published_on"),
    )


LISTING = STAGED + """,
listing AS (
  SELECT source, pos, url, title,
         DATE '2024-01-31' - CAST(floor(pos / 200.0) AS INT)
           - CASE WHEN pos % 17 = 16 THEN 40 ELSE 0 END AS published_on
  FROM staged)"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers of two models per article, some failed, some unreadable."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels")
    x = F.col("doc_id")

    def flag(column: str) -> Column:
        return F.when(F.col(column) == 1, F.lit("true")).otherwise(F.lit("false"))

    m1 = (
        F.when(x % 11 == 0, F.lit(None).cast("string"))
        .when(x % 13 == 0, F.lit("no json here"))
        .otherwise(
            F.concat(
                F.lit('```json {"is_relevant": '), flag("quality"),
                F.lit(', "confidence_score": 0.'), (x % 50 + 50).cast("string"),
                F.lit(', "reasoning": "m1"} ```'),
            )
        )
    )
    m2 = (
        F.when(x % 7 == 0, F.lit(None).cast("string"))
        .when(x % 17 == 0, F.lit("{}"))
        .otherwise(
            F.concat(
                F.lit('{"is_relevant": '), flag("toxic"),
                F.lit(', "confidence_score": 0.'), (x % 90 + 10).cast("string"), F.lit("}"),
            )
        )
    )
    return d.join(labels, "doc_id", "left").select(
        x.alias("article_id"), m1.alias("m1_raw"), m2.alias("m2_raw")
    )


RESPONSES = """
responses AS (
  SELECT d.doc_id AS article_id,
    CASE WHEN d.doc_id % 11 = 0 THEN NULL
         WHEN d.doc_id % 13 = 0 THEN 'no json here'
         ELSE '```json {"is_relevant": ' || CASE WHEN l.quality = 1 THEN 'true' ELSE 'false' END
              || ', "confidence_score": 0.' || CAST(50 + d.doc_id % 50 AS VARCHAR)
              || ', "reasoning": "m1"} ```' END AS m1_raw,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL
         WHEN d.doc_id % 17 = 0 THEN '{}'
         ELSE '{"is_relevant": ' || CASE WHEN l.toxic = 1 THEN 'true' ELSE 'false' END
              || ', "confidence_score": 0.' || CAST(10 + d.doc_id % 90 AS VARCHAR) || '}' END AS m2_raw
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# What the answers above mean, restated from the labels without reading the JSON.
VERDICTS = ARTICLES + """,
signals AS (
  SELECT d.doc_id AS pos,
    CASE WHEN d.doc_id % 11 = 0 THEN 'error' WHEN d.doc_id % 13 = 0 THEN 'parse_error' ELSE 'success' END AS m1_status,
    CASE WHEN d.doc_id % 7 = 0 THEN 'error' WHEN d.doc_id % 17 = 0 THEN 'parse_error' ELSE 'success' END AS m2_status,
    coalesce(l.quality = 1, false) AS q, coalesce(l.toxic = 1, false) AS t,
    CAST('0.' || CAST(50 + d.doc_id % 50 AS VARCHAR) AS DOUBLE) AS c1,
    CAST('0.' || CAST(10 + d.doc_id % 90 AS VARCHAR) AS DOUBLE) AS c2
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
verdicts AS (
  SELECT a.*, m1_status, m2_status,
    m1_status = 'success' AND q AS r1, m2_status = 'success' AND t AS r2,
    CASE WHEN m1_status = 'error' AND m2_status = 'error' THEN 'ERROR'
         WHEN (m1_status = 'success' AND q) OR (m2_status = 'success' AND t) THEN 'TRUE'
         ELSE 'FALSE' END AS label,
    CASE WHEN m1_status = 'success' AND q THEN c1
         WHEN m2_status = 'success' AND t THEN c2
         WHEN m1_status = 'success' THEN c1
         WHEN m2_status = 'success' THEN c2 ELSE 0.0 END AS confidence,
    CASE WHEN m1_status = 'error' AND m2_status = 'error' THEN '双路API调用均失败 (Connection Error)'
         WHEN m1_status = 'success' AND q THEN 'm1'
         WHEN m2_status = 'success' AND t THEN ''
         WHEN m1_status = 'success' THEN 'm1' ELSE '' END AS reasoning,
    CASE WHEN a.abstract <> '' THEN a.abstract ELSE substring(a.content, 1, 200) END AS summary,
    CASE m1_status WHEN 'success' THEN CASE WHEN q THEN 'True' ELSE 'False' END ELSE 'None' END AS m1_is_relevant,
    CASE m2_status WHEN 'success' THEN CASE WHEN t THEN 'True' ELSE 'False' END ELSE 'None' END AS m2_is_relevant,
    CASE m1_status WHEN 'error' THEN 'Connection Failed' WHEN 'parse_error' THEN 'Parse Error' ELSE 'm1' END AS m1_reason,
    CASE m2_status WHEN 'error' THEN 'Connection Failed' WHEN 'parse_error' THEN 'Parse Error' ELSE '' END AS m2_reason,
    m1_status = 'error' AND m2_status = 'error' AS alert
  FROM articles a JOIN signals s ON a.pos = s.pos)"""


def with_sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"
