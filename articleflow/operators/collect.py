"""From listing rows to the items a run accepts, for all sources at once.

Each source's rule row says which steps apply to it, so one plan serves them all.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.functions.dates import resolve_undated, site_date
from articleflow.functions.text import clean_one_line, content_type, make_uid, text_of
from articleflow.operators.filters import (
    category_or_default, content_fallback, derived_abstract, in_lookback, is_skipped_link,
)
from articleflow.operators.blocks import page_content
from articleflow.operators.incremental import first_link_per_source, mark_known, spread_join
from articleflow.operators.ordered import fill_down, first_n, take_while, until_seen_streak
from articleflow.session import settle
from articleflow.sources.pages import extract_blocks, with_rules

PAGE_BITS = 20


def listing_position(page_no: Column, pos: Column) -> Column:
    """Position over all list pages of a source: page first, then place on the page."""
    return F.shiftleft(page_no.cast("bigint"), PAGE_BITS) + pos.cast("bigint")


def accepted_items(
    items: DataFrame, now: Column | date, days: int = 1, pos: str = "pos", history: DataFrame | None = None
) -> DataFrame:
    """Items a run takes from its listings.

    ``items`` are resolved listing rows with their rule columns: source, pos, title,
    link, published_on. Order of the steps: dates from headers, required fields,
    undated policy, repeats, age (stop or filter), known links, cap (0 is none). A listing sorted by date is
    newest first, so its age stop keeps the same rows as a filter does. An entry without any date text
    is skipped where a rule needs one; one with an unreadable date follows the undated policy. The items are
    read several times: pass a stored table, not pages still to be walked. With
    ``page_no``, counted from 1, list pages beyond a rule's ``page_cap`` are left out.
    """
    today = F.lit(now).cast("date")
    if "page_no" in items.columns:
        items = items.filter((F.col("page_cap") <= 0) | (F.col("page_no") <= F.col("page_cap")))
    header = F.col("date_headers") & (text_of(F.col("link")) == "")
    own = items.filter(~F.col("date_headers"))
    under = fill_down(
        items.filter(F.col("date_headers")), ["source"], pos, header, F.col("published_on"), "_day"
    ).drop("_day_pos")
    under = under.withColumn("published_on", F.col("_day")).drop("_day")
    rows = own.unionByName(under).filter(
        (text_of(F.col("link")) != "")
        & (~F.col("needs_title") | (text_of(F.col("title")) != ""))
        & ~(F.col("needs_date") & (text_of(F.col("date_raw")) == ""))
        & ~(F.col("skip_documents") & is_skipped_link(F.col("link"), F.col("title")))
    )
    dated = rows.withColumn("published_on", resolve_undated(F.col("published_on"), F.col("on_unparsed"), today))
    kept = dated.filter(F.col("published_on").isNotNull() | (F.col("on_unparsed") == "keep_raw"))
    # A site sorted by date offers its newest entry of a link first, wherever it stands on the page.
    newest = F.when(F.col("sort_by_date"), F.unix_date("published_on")).desc_nulls_last()
    once = first_link_per_source(kept, "source", "link", newest, pos)
    recent = in_lookback(F.col("published_on"), now, days) | F.col("published_on").isNull()
    stops = F.col("take_while") & ~F.col("sort_by_date")
    rows = take_while(once, ["source"], pos, recent, stops)
    if history is not None:
        # The recent items, a small part of the listings, are read several times from here.
        rows = without_known(settle(rows, "recent-items"), history, pos)
    return first_n(rows, ["source"], pos, F.col("cap"))


def without_known(items: DataFrame, history: DataFrame, pos: str) -> DataFrame:
    """Drop known links of the sources that ask for it; with a ``seen_limit`` the scan
    of a source ends at that many known links in a row."""
    named = mark_known(items.withColumn("url", F.col("link")), history, "url", "_known").drop("url")
    ending = named.filter(F.col("seen_limit") > 0)
    ended = until_seen_streak(ending, ["source"], pos, F.col("_known"), F.col("seen_limit"))
    rest = named.filter((F.col("seen_limit") <= 0) & ~(F.col("drop_known") & F.col("_known")))
    return rest.unionByName(ended).drop("_known")


def with_page_date(items: DataFrame, now: Column | date) -> DataFrame:
    """Let the date shown on an item's own page replace its listing date.

    Where a rule reads one, an unreadable or absent date follows the undated policy;
    an item whose page was not read keeps its listing date.
    """
    today = F.lit(now).cast("date")
    shown = resolve_undated(
        site_date(F.col("date_style"), F.col("page_date"), today), F.col("on_unparsed"), today
    )
    return items.withColumn(
        "published_on", F.when(F.col("page_date").isNotNull(), shown).otherwise(F.col("published_on"))
    )


def as_articles(items: DataFrame, crawl_time: Column) -> DataFrame:
    """Accepted items with their ``content`` as article columns.

    The date text of an undated item is kept as it was read.
    """
    c = F.col
    return items.select(
        "pos",
        make_uid(c("source"), c("link")).alias("uid"), c("source"), c("entity"),
        category_or_default(c("category"), c("site_category")).alias("category"),
        F.coalesce(c("published_on").cast("string"), clean_one_line(c("date_raw"))).alias("published_at"),
        clean_one_line(c("title")).alias("title"), clean_one_line(c("link")).alias("url"),
        derived_abstract(c("abstract_mode"), c("abstract"), c("content")).alias("abstract"),
        clean_one_line(content_fallback(c("fallback_chain"), c("content"), c("abstract"), c("title"))).alias("content"),
        F.when(c("pdf_marker"), content_type(c("link"))).otherwise(F.lit("html")).alias("content_type"),
        crawl_time.alias("crawl_time"),
    )


def entry_articles(entries: DataFrame, landed: DataFrame, crawl_time: Column, pos: str = "pos") -> DataFrame:
    """New feed entries as articles, with the text of the page that each one links to.

    ``entries`` come from ``resolve_entries``, after window, repeats and known ones; ``landed`` has
    url and html. Only pages that an entry links to are walked, each once, by the rule of feeds. The first of
    several landings of a page counts; an entry without a landed page, or one that is no page, has no content.
    The entries are read several times: pass a stored table.
    """
    links = entries.select("url").filter(F.col("url") != "").distinct()
    first = landed.groupBy("url").agg(F.min("html").alias("html"))
    wanted = spread_join(first, links, ["url"], "left_semi").withColumn("source", F.when(F.col("url") != "", F.lit("rss")))
    walked = page_content(extract_blocks(with_rules(wanted))).select("url", "content")
    rows = spread_join(entries, walked, ["url"], "left")
    return rows.select(
        pos, "uid", "source", "entity", "category", "published_at", "title", "url", "abstract",
        clean_one_line(F.when(F.col("content_type") == "html", F.col("content"))).alias("content"), "content_type", crawl_time.alias("crawl_time"),
    )
