"""Feed documents (RSS, RDF, Atom) to entries, and the registry that names feeds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.functions.dates import entry_date
from articleflow.functions.text import (
    absolute_url, clean_one_line, content_type, first_filled, html_text, make_uid, strip, text_of,
)
from articleflow.operators.incremental import sized, spread_join

ITEM_SCHEMA = (
    "title string, link string, pubDate string, published string, `dc:date` string, "
    "updated string, created string, description string, summary string, guid string, `content:encoded` string"
)
_ITEM = "array<struct<" + ", ".join(
    part.strip().replace(" string", ":string") for part in ITEM_SCHEMA.split(",")
) + ">>"
_LINK = "array<struct<_href:string,_rel:string>>"
_ENTRY = (
    f"array<struct<title:string,link:{_LINK},published:string,updated:string,created:string,"
    "summary:string,content:string>>"
)
FEED_SCHEMA = f"channel struct<item:{_ITEM}>, item {_ITEM}, entry {_ENTRY}"
ENTRY_SCHEMA = (
    f"title string, link {_LINK}, published string, updated string, created string, "
    "summary string, content string"
)

# Feeds by entity (entity|kind|category|address).
REGISTRY_TEXT = """
美国|工作论文|工作论文|https://www.federalreserve.gov/feeds/working_papers.xml
美国|董事会议|董事会议|https://www.federalreserve.gov/feeds/boardmeetings.xml
美国|演讲|演讲|https://www.federalreserve.gov/feeds/speeches.xml
美国|新闻稿|新闻稿|https://www.federalreserve.gov/feeds/press_all.xml
加拿大|数字货币和金融科技|数字货币和金融科技|https://www.bankofcanada.ca/topic/digital-currencies/feed/
加拿大|加密货币|加密货币|https://www.bankofcanada.ca/topic/cryptocurrencies/feed/
加拿大|央行研究|央行研究|https://www.bankofcanada.ca/topic/central-bank-research/feed/
加拿大|工作人员分析笔记|工作人员分析笔记|https://www.bankofcanada.ca/content_type/staff-analytical-notes/feed/
加拿大|工作人员讨论文件|工作人员讨论文件|https://www.bankofcanada.ca/content_type/discussion-papers/feed/
加拿大|工作人员工作文件|工作人员工作文件|https://www.bankofcanada.ca/content_type/working-papers/feed/
加拿大|技术报告|技术报告|https://www.bankofcanada.ca/content_type/technical-reports/feed/
加拿大|其他|其他|https://www.bankofcanada.ca/content_type/other/feed/
加拿大|新闻稿|新闻稿|https://www.bankofcanada.ca/content_type/press-releases/feed/
加拿大|公告|公告|https://www.bankofcanada.ca/content_type/announcements/feed/
加拿大|新闻|新闻|https://www.bankofcanada.ca/utility/news/feed/
加拿大|年报|年报|https://www.bankofcanada.ca/content_type/annual-report/feed/
加拿大|金融系统中心|金融系统中心|https://www.bankofcanada.ca/content_type/financial-system-hub/feed/
欧元区|新闻稿演讲稿|新闻稿演讲稿|https://www.ecb.europa.eu/rss/press.html
欧元区|博客文章|博客文章|https://www.ecb.europa.eu/rss/blog.html
欧元区|出版物|出版物|https://www.ecb.europa.eu/rss/pub.html
欧元区|工作文件，PDF格式|工作文件，pdf格式|https://www.ecb.europa.eu/rss/wppub.html
欧元区|研究简报|研究简报|https://www.ecb.europa.eu/rss/rbu.html
瑞典|新闻稿|新闻稿|https://www.riksbank.se/en-gb/rss/press-releases/
瑞典|通知|通知|https://www.riksbank.se/en-gb/rss/notices/
瑞典|演讲|演讲|https://www.riksbank.se/en-gb/rss/speeches/
丹麦|分析|分析|https://www.nationalbanken.dk/api/rssfeed?topic=Analysis&lang=zh-CN
丹麦|报告|报告|https://www.nationalbanken.dk/api/rssfeed?topic=Report&lang=zh-CN
丹麦|经济备忘录|经济备忘录|https://www.nationalbanken.dk/api/rssfeed?topic=Economic+Memo&lang=zh-CN
丹麦|工作文件|工作文件|https://www.nationalbanken.dk/api/rssfeed?topic=Working+Paper&lang=zh-CN
丹麦|消息|消息|https://www.nationalbanken.dk/api/rssfeed?topic=News&lang=zh-CN
丹麦|其他出版物|其他出版物|https://www.nationalbanken.dk/api/rssfeed?topic=Other+publications&lang=zh-CN
英国|事件|事件|https://www.bankofengland.co.uk/rss/events
英国|消息|消息|https://www.bankofengland.co.uk/rss/news
英国|出版物|出版物|https://www.bankofengland.co.uk/rss/publications
英国|演讲|演讲|https://www.bankofengland.co.uk/rss/speeches
瑞士|新闻稿|新闻稿|https://www.snb.ch/public/en/rss/pressrel
瑞士|演讲|演讲|https://www.snb.ch/public/en/rss/speeches
瑞士|季度公告|季度公告|https://www.snb.ch/public/en/rss/quartbul
瑞士|年报|年报|https://www.snb.ch/public/en/rss/annrep
瑞士|研究报告|研究报告|https://www.snb.ch/public/en/rss/researchreports
瑞士|工作论文|工作论文|https://www.snb.ch/public/en/rss/papers
土耳其|出版物|出版物|https://www.tcmb.gov.tr/wps/wcm/connect/EN/TCMB+EN/Bottom+Menu/Other/RSS/Publications
土耳其|演讲|演讲|https://www.tcmb.gov.tr/wps/wcm/connect/EN/TCMB+EN/Bottom+Menu/Other/RSS/Remarks+by+Governor
土耳其|新闻稿|新闻稿|https://www.tcmb.gov.tr/wps/wcm/connect/EN/TCMB+EN/Bottom+Menu/Other/RSS/Press+Releases
日本|all|all|https://www.boj.or.jp/en/rss/whatsnew.xml
韩国|支付和结算系统年度报告|支付和结算系统年度报告|https://www.bok.or.kr/eng/bbs/E0000866/news.rss?menuNo=400047
韩国|统计数据和出版物|统计数据和出版物|https://www.bok.or.kr/eng/bbs/E0000654/news.rss?menuNo=400048
韩国|季度简报|季度简报|https://www.bok.or.kr/eng/bbs/E0000829/news.rss?menuNo=400216
韩国|年度报告|年度报告|https://www.bok.or.kr/eng/bbs/E0000740/news.rss?menuNo=400221
韩国|新闻稿|新闻稿|https://www.bok.or.kr/eng/bbs/E0000634/news.rss?menuNo=400069
韩国|演讲|演讲|https://www.bok.or.kr/eng/bbs/E0002382/news.rss?menuNo=400074
印度|新闻稿|新闻稿|https://rbi.org.in/pressreleases_rss.xml
印度|通知|通知|https://rbi.org.in/notifications_rss.xml
印度|演讲|演讲|https://rbi.org.in/speeches_rss.xml
印度|出版物|出版物|https://rbi.org.in/Publication_rss.xml
阿联酋|出版物|出版物|https://www.centralbank.ae/en/rss-feed/publications-rss-feed/
阿联酋|事件|事件|https://www.centralbank.ae/en/rss-feed/events-rss-feed/
阿联酋|新闻|新闻|https://www.centralbank.ae/en/rss-feed/news-and-insights/
澳大利亚|媒体发布|媒体发布|https://www.rba.gov.au/rss/rss-cb-media-releases.xml
澳大利亚|演讲|演讲|https://www.rba.gov.au/rss/rss-cb-speeches.xml
澳大利亚|演讲网络直播|演讲网络直播|https://www.rba.gov.au/rss/rss-cb-speeches-webcast.xml
澳大利亚|公告|公告|https://www.rba.gov.au/rss/rss-cb-bulletin.xml
南非|all|all|https://www.resbank.co.za/bin/sarb/solr/publications/rss
bis|all|all|https://www.bis.org/doclist/rss_all_categories.rss
意大利|all|all|https://www.bancaditalia.it/util/index.rss.html?lingua=en
"""

# Addresses in front of relative links.
ENTITY_BASE = {"土耳其": "https://www.tcmb.gov.tr", "南非": "https://www.resbank.co.za"}

REGISTRY_COLUMNS = "entity string, entity_type string, rss_type string, feed_url string, base_url string"


def feed_registry(spark: SparkSession) -> DataFrame:
    rows = []
    for line in REGISTRY_TEXT.strip().splitlines():
        entity, kind, category, url = line.split("|")
        rows.append((entity, kind, category, url, ENTITY_BASE.get(entity, "")))
    names = [part.split()[0] for part in REGISTRY_COLUMNS.split(", ")]
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows))))))


def _first_date(item: Column, names: list[str]) -> Column:
    return first_filled(*[item[n] for n in names])


def _rss_entry(item: Column) -> Column:
    """Title, link (or a permanent id that is one), first date, and summary or full text."""
    guid = strip(text_of(item["guid"]))
    return F.struct(
        text_of(item["title"]).alias("title"),
        first_filled(strip(text_of(item["link"])), F.when(guid.startswith("http"), guid)).alias("link"),
        _first_date(item, ["pubDate", "published", "dc:date", "updated", "created"]).alias("date_raw"),
        first_filled(item["summary"], item["description"], item["content:encoded"]).alias("summary"),
    )


def _atom_entry(entry: Column) -> Column:
    main = F.filter(entry["link"], lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate")
    href = F.coalesce(F.get(main, F.lit(0)), F.get(entry["link"], F.lit(0)))["_href"]
    return F.struct(
        text_of(entry["title"]).alias("title"),
        text_of(href).alias("link"),
        _first_date(entry, ["published", "updated", "created"]).alias("date_raw"),
        first_filled(entry["summary"], entry["content"]).alias("summary"),
    )


def feed_entries(documents: DataFrame, xml: str) -> DataFrame:
    """One row per entry of the feed documents in column ``xml``; other columns stay.

    RSS, RDF and Atom are read in one pass. A document that is no feed has no rows.
    """
    keep = [c for c in documents.columns if c != xml]
    parsed = documents.select(*keep, F.from_xml(F.col(xml), F.lit(FEED_SCHEMA)).alias("_f"))
    none = F.array()
    entries = F.concat(
        F.coalesce(F.transform(F.col("_f.channel.item"), _rss_entry), none),
        F.coalesce(F.transform(F.col("_f.item"), _rss_entry), none),
        F.coalesce(F.transform(F.col("_f.entry"), _atom_entry), none),
    )
    exploded = parsed.select(*keep, F.posexplode(entries).alias("entry_pos", "_e"))
    return exploded.select(*keep, "entry_pos", "_e.*")


def read_feed_files(spark: SparkSession, path: str, kind: str = "rss", stream: bool = False) -> DataFrame:
    """Entries of landed feed files; large files are split at their items.

    ``kind`` is ``rss`` (also RDF) or ``atom``. ``stream`` reads new files as they land.
    """
    reader = spark.readStream if stream else spark.read
    tag, schema, build = (
        ("item", ITEM_SCHEMA, _rss_entry) if kind == "rss" else ("entry", ENTRY_SCHEMA, _atom_entry)
    )
    raw = reader.format("xml").schema(schema).option("rowTag", tag).load(path)
    item = F.struct(*[F.col(f"`{c}`") for c in raw.columns])
    rows = raw.select(item.alias("_i"), F.col("_metadata.file_path").alias("feed_file"))
    return rows.select("feed_file", build(F.col("_i")).alias("_e")).select("feed_file", "_e.*")


def resolve_entries(entries: DataFrame, registry: DataFrame, current_year: int) -> DataFrame:
    """Feed entries as article columns, before any window or repeat is considered.

    ``feed_url`` names the feed. The uid comes from the raw absolute link, the stored
    url is cleaned. Entries without any date are dropped.
    """
    day = F.to_date(F.substring("published_at", 1, 10))
    # A registry is small in nearly every case; a stream can't count its keys first.
    if entries.isStreaming:
        joined = entries.join(registry, "feed_url")
    else:
        joined = spread_join(entries, sized(registry, "registry"), ["feed_url"], "inner")
    link = absolute_url(F.col("link"), F.col("base_url"))
    search = F.concat(text_of(F.col("title")), F.lit(" "), text_of(F.col("summary")))
    keep = [c for c in entries.columns if c not in ("title", "link", "date_raw", "summary")]
    return joined.select(
        *keep,
        make_uid(F.lit("rss"), link).alias("uid"),
        F.lit("rss").alias("source"),
        clean_one_line(F.col("entity")).alias("entity"),
        clean_one_line(first_filled(F.col("rss_type"), F.col("entity_type"))).alias("category"),
        entry_date(F.col("date_raw"), search, current_year).alias("published_at"),
        clean_one_line(F.col("title")).alias("title"),
        clean_one_line(link).alias("url"),
        html_text(F.col("summary")).alias("abstract"),
        content_type(link).alias("content_type"),
    ).filter(F.col("published_at") != "").withColumn("published_on", day)
