"""Row filters, date policies and fallback projections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.functions.dates import resolve_undated
from articleflow.functions.text import clean_one_line, first_filled, text_of

# Document extensions and title words that mark non-articles.
SKIP_EXTENSIONS = ["pdf", "xlsx", "xls", "doc", "docx", "zip", "rar"]
SKIP_WORDS = ["annex", "attachment", "chart", "figure", "table"]

# Text blocks that are no content.
END_MARKS = r"(?i)^\s*(\*{3}|End\s+of\s+Document)\s*$"
READING_TIME = r"^(本文共\d+字|预计阅读时间)"


def in_lookback(published_on: Column, now: Column | date, days: int = 1) -> Column:
    """Dated from the start of the day ``days`` before ``now``; no upper bound."""
    return published_on >= F.date_sub(F.lit(now).cast("date"), days)


def lookback(df: DataFrame, now: Column | date, days: int = 1, day: str = "published_on") -> DataFrame:
    return df.filter(in_lookback(F.col(day), now, days))


def apply_undated_policy(
    df: DataFrame, now: Column | date, day: str = "published_on", policy: str = "on_unparsed", days: int = 1
) -> DataFrame:
    """``drop`` removes undated items, ``today`` dates them today, ``keep_raw`` lets
    them pass the window undated."""
    resolved = df.withColumn(day, resolve_undated(F.col(day), F.col(policy), F.lit(now).cast("date")))
    raw = F.col(day).isNull() & (F.col(policy) == "keep_raw")
    return resolved.filter(raw | in_lookback(F.col(day), now, days))


def required_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    for name in fields:
        df = df.filter(text_of(F.col(name)) != "")
    return df


def is_skipped_link(link: Column, title: Column) -> Column:
    by_type = text_of(link).rlike(r"(?i)\.(" + "|".join(SKIP_EXTENSIONS) + r")\z")
    words = F.array(*[F.lit(w) for w in SKIP_WORDS])
    return by_type | F.exists(words, lambda w: F.contains(F.lower(text_of(title)), w))


def skip_links(df: DataFrame, link: str = "url", title: str = "title") -> DataFrame:
    return df.filter(~is_skipped_link(F.col(link), F.col(title)))


def select_sources(
    df: DataFrame, only: list[str] | None = None, skip: list[str] | None = None
) -> DataFrame:
    """Keep the ``only`` sources, then remove the ``skip`` ones; unknown names do nothing."""
    if only:
        df = df.filter(F.col("source").isin(*only))
    if skip:
        df = df.filter(~F.col("source").isin(*skip))
    return df


def missing_content(df: DataFrame) -> DataFrame:
    return df.filter((text_of(F.col("url")) != "") & (text_of(F.col("content")) == ""))


def category_or_default(category: Column, default: Column) -> Column:
    return first_filled(clean_one_line(category), default)


def derived_abstract(mode: Column, abstract: Column, content: Column) -> Column:
    """``listing`` keeps the abstract, ``prefix300`` and ``prefix5000`` cut the raw
    content before it is cleaned, anything else is empty."""
    content = text_of(content)
    return (
        F.when(mode == "listing", clean_one_line(abstract))
        .when(mode == "prefix300", clean_one_line(F.substring(content, 1, 300)))
        .when(mode == "prefix5000", clean_one_line(F.substring(content, 1, 5000)))
        .otherwise(F.lit(""))
    )


def content_fallback(chain: Column, content: Column, abstract: Column, title: Column) -> Column:
    """Stand-in for empty content, chosen by the rule's chain."""
    content, abstract, title = text_of(content), text_of(abstract), text_of(title)
    return (
        F.when(content != "", content)
        .when(chain == "abstract", clean_one_line(abstract))
        .when(chain == "abstract_title", clean_one_line(first_filled(abstract, title)))
        .when(chain == "title", clean_one_line(title))
        .otherwise(F.lit(""))
    )
