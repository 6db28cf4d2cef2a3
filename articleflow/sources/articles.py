"""Article tables, the scored corpus, and checks of landed CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.functions.text import text_of
from articleflow.schema import ARTICLE, ARTICLE_FIELDS, CORPUS, EVALUATED

BAD = "_bad_record"


def _csv(spark: SparkSession, schema: T.StructType):
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("escape", '"').option("encoding", "UTF-8")
    )


def _filled(df: DataFrame) -> DataFrame:
    return df.select(*[text_of(F.col(c)).alias(c) for c in df.columns])


def read_articles(spark: SparkSession, path: str, fmt: str = "csv", evaluated: bool = False) -> DataFrame:
    """An article table; missing values become empty.

    CSV with quoted line breaks cannot be split within a file, so it is an exchange
    format: keep the files moderate. Parquet is the format for large tables.
    """
    schema = EVALUATED if evaluated else ARTICLE
    if fmt == "csv":
        return _filled(_csv(spark, schema).csv(path))
    return _filled(spark.read.schema(schema).format(fmt).load(path))


def with_corpus_defaults(df: DataFrame) -> DataFrame:
    """Absent or null texts are empty, an absent or null entity is ``Source``."""
    defaults = {"title": "", "abstract": "", "content": "", "url": "", "entity": "Source"}

    def value(name: str):
        if name not in df.columns:
            return F.lit(defaults[name])
        return F.coalesce(F.col(name).cast("string"), F.lit(defaults[name]))

    others = [c for c in df.columns if c not in defaults]
    return df.select(*others, *[value(n).alias(n) for n in defaults])


def read_corpus(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A JSON array of records, or JSON Lines (splittable) without ``multi_line``."""
    return with_corpus_defaults(spark.read.schema(CORPUS).option("multiLine", multi_line).json(path))


def validate_articles(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Shape check of CSV files: rows, malformed rows, an example, and empty values.

    Counting the empty values also makes the reader parse every column, without which
    it would not notice short and long records.
    """
    names = columns or ARTICLE_FIELDS
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD]])
    rows = (
        _csv(spark, schema).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD).option("enforceSchema", True).csv(path)
    )
    bad = F.col(BAD)
    empty = sum((F.when(text_of(F.col(n)) == "", 1).otherwise(0) for n in names), F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count(bad).alias("malformed"), F.min(bad).alias("example"),
        F.sum(F.when(bad.isNull(), empty)).alias("empty_values"),
    )


def validate_headers(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One row for each CSV file: its path, how many columns its header names, and whether these are
    as many as expected. A file without any record has none and counts as sound.

    Every task passes on one line of a file.
    """
    expected = len(columns or ARTICLE_FIELDS)
    place = F.col("_metadata.file_path").alias("file")
    lines = spark.read.text(path).select(place, F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("start", "at")).alias("header"))
    # Quoted names may hold commas.
    bare = F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), r'"(?:[^"]|"")*"', "")
    width = F.when(F.col("header") == "", F.lit(0)).otherwise(F.regexp_count(bare, F.lit(",")) + 1).cast("long")
    return first.select("file", width.alias("columns"), ((width == expected) | (width == 0)).alias("ok"))


def parse_lines(lines: DataFrame, line: str, columns: list[str]) -> DataFrame:
    """CSV records held in a column: the other columns, the fields, and ``BAD`` with a record that has
    too few or too many of them (null for a sound one)."""
    keep = [c for c in lines.columns if c != line]
    schema = ", ".join([*[f"`{c}` string" for c in columns], f"{BAD} string"])
    parsed = F.from_csv(F.col(line), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "escape": '"'})
    return lines.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


def validate_lines(lines: DataFrame, line: str, pos: str, columns: int) -> DataFrame:
    """The same check on CSV records held in a column; ``first_bad`` is a position."""
    parsed = parse_lines(lines.select(pos, line), line, [f"c{i}" for i in range(columns)])
    bad = F.col(BAD).isNotNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(bad, F.lit(1))).alias("malformed"),
        F.min(F.when(bad, F.col(pos))).alias("first_bad"),
    )


def column_fill(df: DataFrame) -> DataFrame:
    """Per column, how many values are empty. One pass over the table."""
    counts = df.agg(
        *[F.count(F.when(text_of(F.col(c)) == "", F.lit(1))).alias(c) for c in df.columns]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("empty")) for c in df.columns])
    return counts.select(F.inline(pairs))
