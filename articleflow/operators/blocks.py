"""Text blocks of a page, as an array on the page's own row.

Blocks of one page never leave their row, so filtering, trimming, choosing a
container and joining the text need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.functions.text import strip


def keep_blocks(
    blocks: Column, min_length: Column | int = 1, drop_pattern: str | None = None,
    free_tags: tuple[str, ...] = (),
) -> Column:
    """Blocks of at least ``min_length`` characters that are no boilerplate.

    ``free_tags`` are exempt from the length test.
    """
    least = min_length if isinstance(min_length, Column) else F.lit(min_length)

    def wanted(b: Column) -> Column:
        ok = F.length(b["text"]) >= least
        if free_tags:
            ok = ok | (b["tag"].isin(*free_tags) & (b["text"] != ""))
        return ok & ~b["text"].rlike(drop_pattern) if drop_pattern else ok

    return F.filter(blocks, wanted)


def trim_blocks(blocks: Column, head: int = 2, tail: int = 3, over: int = 5) -> Column:
    """Without a container: drop the first ``head`` and last ``tail`` of more than ``over``."""
    n = F.size(blocks)
    return F.when(n > over, F.slice(blocks, F.lit(head + 1), n - head - tail)).otherwise(blocks)


def join_blocks(blocks: Column, separator: Column | str) -> Column:
    sep = F.lit(separator) if isinstance(separator, str) else separator
    return F.call_function("array_join", F.transform(blocks, lambda b: b["text"]), sep)


def in_container(blocks: Column, container: Column | int) -> Column:
    wanted = F.lit(container) if isinstance(container, int) else container
    return F.filter(blocks, lambda b: b["container"] == wanted)


def container_texts(blocks: Column, separator: Column | str) -> Column:
    """``array<struct<idx,text>>`` of the containers in priority order, those >= 0."""
    ids = F.array_sort(F.array_distinct(F.transform(blocks, lambda b: b["container"])))
    return F.transform(
        F.filter(ids, lambda i: i >= 0),
        lambda i: F.struct(
            i.alias("idx"), strip(join_blocks(in_container(blocks, i), separator)).alias("text")
        ),
    )


def longest_container(texts: Column) -> Column:
    """Longest text; the first of equally long ones."""
    ranked = F.transform(
        texts,
        lambda t: F.struct(F.length(t["text"]).alias("n"), (-t["idx"]).alias("i"), t["text"].alias("t")),
    )
    return F.coalesce(F.array_max(ranked)["t"], F.lit(""))


def sufficient_container(texts: Column, whole_page: Column, enough: int = 100) -> Column:
    """First container longer than ``enough``, else the last with any text, else the page."""
    long = F.filter(texts, lambda t: F.length(t["text"]) > enough)
    some = F.filter(texts, lambda t: t["text"] != "")
    return F.coalesce(
        F.get(long, F.lit(0))["text"], F.get(some, F.size(some) - 1)["text"], whole_page
    )


def block_rows(pages: DataFrame, id_column: str, blocks: str = "blocks") -> DataFrame:
    """One row per block."""
    texts = F.filter(F.col(blocks), lambda b: b["container"] >= -1)
    return pages.select(id_column, F.explode(texts).alias("b")).select(
        id_column, F.col("b.container"), F.col("b.pos"), F.col("b.tag"), F.col("b.text")
    )


def page_content(pages: DataFrame) -> DataFrame:
    """Add ``content`` from ``blocks`` and the page's rule columns, and ``page_date``,
    the raw date a page shows, null where the rule names none.

    ``pick`` is ``first``, ``longest`` or ``sufficient``; container -1 holds the
    blocks of the whole page, present only when no container gave any.
    """
    sep, pick = F.col("separator"), F.col("pick")

    def wanted(b: Column) -> Column:
        least = F.when(b["container"] >= 0, F.col("min_length")).otherwise(F.col("loose_min_length"))
        free = F.col("free_li") & (b["tag"] == "li") & (b["text"] != "")
        noise = (F.col("drop_pattern") != "") & F.rlike(b["text"], F.col("drop_pattern"))
        return ((F.length(b["text"]) >= least) | free) & ~noise

    kept = F.filter(F.col("blocks"), wanted)
    loose = in_container(kept, -1)
    page_text = join_blocks(F.when(F.col("trim"), trim_blocks(loose)).otherwise(loose), sep)
    texts = container_texts(kept, sep)
    text = (
        F.when(F.size(texts) == 0, page_text)
        .when(pick == "longest", longest_container(texts))
        .when(pick == "sufficient", sufficient_container(texts, page_text))
        .otherwise(F.get(texts, F.lit(0))["text"])
    )
    marker = F.col("pdf_marker") & F.lower(F.col("url")).endswith(".pdf")
    content = F.when(marker, F.concat(F.lit("[PDF] "), F.col("url"))).otherwise(strip(text))
    stamp = F.get(in_container(F.col("blocks"), -2), F.lit(0))["text"]
    return pages.withColumns({"content": content, "page_date": stamp})
