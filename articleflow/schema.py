"""Schemas of the tables that move between operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The article columns, in table order.
ARTICLE_FIELDS = [
    "uid", "source", "entity", "category", "published_at", "title", "url",
    "abstract", "content", "content_type", "crawl_time", "is_relevant",
]
VERDICT_FIELDS = ["is_relevant", "m1_is_relevant", "m1_reason", "m2_is_relevant", "m2_reason"]
MULTI_LINE_FIELDS = ["title", "abstract", "content"]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ARTICLE = _strings(ARTICLE_FIELDS)
EVALUATED = _strings(ARTICLE_FIELDS + VERDICT_FIELDS[1:])
CORPUS = _strings(["title", "abstract", "content", "url", "entity"])

LISTING = (
    "source string, page_id bigint, pos int, date_raw string, title string, "
    "link string, abstract string, category string"
)
BLOCKS = "array<struct<container:int,pos:int,tag:string,text:string>>"
