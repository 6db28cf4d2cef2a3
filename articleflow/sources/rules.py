"""Site rules: one row per source says how its pages are read.

``|`` separates selectors tried in order, ``,`` selectors of equal rank.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RULE_SCHEMA = (
    "source string, entity string, category string, base_url string, directory string, "
    "item string, item_date string, item_title string, item_link string, item_abstract string, "
    "item_category string, date_style string, on_unparsed string, take_while boolean, sort_by_date boolean, "
    "cap int, containers string, block_tags string, loose_tags string, body_text boolean, remove string, "
    "tight_tags string, pick string, separator string, min_length int, loose_min_length int, "
    "free_li boolean, trim boolean, drop_pattern string, pdf_marker boolean, "
    "abstract_mode string, fallback_chain string, needs_title boolean, date_headers boolean, "
    "skip_documents boolean, drop_known boolean, seen_limit int, page_cap int, detail_date string, needs_date boolean, line_dates string"
)

_DEFAULTS = {
    "base_url": "", "directory": "", "item": "", "item_date": "", "item_title": "", "item_link": "",
    "item_abstract": "", "item_category": "", "date_style": "feed", "on_unparsed": "drop",
    "take_while": True, "sort_by_date": False, "cap": 0, "containers": "", "block_tags": "p",
    "loose_tags": "", "body_text": False, "remove": "", "tight_tags": "", "pick": "first",
    "separator": "\n\n", "min_length": 1, "loose_min_length": 1, "free_li": False, "trim": False,
    "drop_pattern": "", "pdf_marker": False, "abstract_mode": "listing", "fallback_chain": "",
    "needs_title": False, "date_headers": False, "skip_documents": False, "drop_known": False,
    "seen_limit": 0, "page_cap": 0, "detail_date": "", "needs_date": False, "line_dates": "",
}

# The job order of the sources.
JOB_ORDER = [
    "rss", "weiyang", "mas", "bi", "sama", "imf", "tcmb", "cbr", "boj", "ecb", "bcra",
    "bahamas", "bdf", "mnb",
]

# Attributes, selectors, formats and policies per source.
SITE_RULES = [
    {
        "source": "rss", "entity": "", "category": "", "take_while": False, "cap": 0,
        "containers": "main | article | div[id*=content],div[id*=article],div[id*=body],div[id*=text]"
        " | div[class*=content],div[class*=article],div[class*=body],div[class*=text],"
        "div[class*=speech],div[class*=press] | body",
        "block_tags": "h1,h2,h3,h4,p,li,blockquote", "min_length": 6,
        "remove": "script,style,header,footer,nav,aside,iframe,noscript,form,button,svg,img,"
        "figcaption,table,hr,meta,link,input,select,textarea,[class*=disclaimer],[class*=footer],"
        "[class*=copyright],[class*=share],[class*=social],[class*=related],[class*=sidebar],"
        "[class*=advert],[class*=breadcrumb],[class*=cookies]",
    },
    {
        "source": "imf", "needs_title": True, "drop_known": True, "seen_limit": 30,
        "entity": "IMF", "category": "news", "item": "atomic-result",
        "item_date": "atomic-text[value]@value", "item_title": "a[href*=/news/articles/]",
        "item_link": "a[href*=/news/articles/]", "item_abstract": "[class*=excerpt]",
        "date_style": "month_day_year", "on_unparsed": "keep_raw", "cap": 0,
        "containers": ".article-body | .news-article | article | main", "loose_tags": "p",
        "pick": "sufficient", "separator": " ",
    },
    {
        "source": "tcmb", "needs_title": True, "entity": "土耳其", "category": "press_releases",
        "base_url": "https://www.tcmb.gov.tr", "item": "div.block-collection-box",
        "item_date": "div.collection-tag", "item_title": "a.collection-title",
        "item_link": "a.collection-title", "date_style": "numeric", "sort_by_date": True, "cap": 0,
        "containers": "div.tcmb-content.type-prg", "block_tags": "p,h2,h3", "loose_tags": "p",
        "separator": " ", "abstract_mode": "prefix300",
    },
    {
        "source": "cbr", "needs_title": True, "entity": "俄罗斯", "category": "news", "base_url": "https://www.cbr.ru",
        "item": "div.news", "item_date": "div.news_date", "item_title": "a.news_title",
        "item_link": "a.news_title", "item_category": "div.news_category",
        "date_style": "day_month_year", "sort_by_date": True, "cap": 0,
        "containers": "div.full_text,div.article_body,div.content",
        "block_tags": "p,h2,h3,div.paragraph", "loose_tags": "p", "separator": " ", "trim": True,
        "abstract_mode": "prefix300",
    },
    {
        "source": "boj", "needs_title": True, "entity": "日本", "category": "whatsnew",
        "base_url": "https://www.boj.or.jp", "date_style": "dotted_month", "sort_by_date": True,
        "cap": 0, "containers": "div.outline.mod_outer,div#content,div.main,article,body > div",
        "block_tags": "h1,h2,h3,p,li,ul.link-list01 a", "loose_tags": "p,h2,h3", "body_text": True,
        "min_length": 6, "loose_min_length": 11, "pdf_marker": True, "abstract_mode": "prefix300",
        "line_dates": r"^(\+?\s*[A-Za-z]+\.\s*\d{1,2},\s*\d{4})",
    },
    {
        "source": "ecb", "date_headers": True, "skip_documents": True, "drop_known": True,
        "entity": "欧央行", "category": "press",
        "base_url": "https://www.ecb.europa.eu", "item": "dl > dt,dl > dd",
        "item_title": ".title a", "item_link": ".title a", "date_style": "before_comma", "cap": 0,
        "containers": "main | div.section", "block_tags": "h1,h2,h3,h4,p,li",
        "loose_tags": "h1,h2,h3,h4,p,li", "pick": "longest", "min_length": 20,
        "loose_min_length": 20, "free_li": True, "abstract_mode": "prefix5000",
        "remove": "header,footer,nav,aside,sup,.ecb-doc-header,.ecb-doc-footer,"
        ".ecb-social-sharing,.related-topics,.address-box,.ecb-breadcrumbscontainer,"
        ".ecb-publicationDate,.ecb-authors,.info-box,#cookieConsent,#feedback",
    },
    {
        "source": "mas", "entity": "新加坡", "category": "news", "base_url": "https://www.mas.gov.sg",
        "item": "article.mas-search-card", "item_date": "div[class*=ts:xs]",
        "item_title": "a.mas-link--no-underline span.mas-link__text",
        "item_link": "a.mas-link--no-underline", "item_abstract": ".mas-search-card__body p",
        "date_style": "after_label", "on_unparsed": "today",
        "containers": "div._mas-typeset | div.mas-rte-content",
        "block_tags": "p,h1,h2,h3,h4,li,td,th", "fallback_chain": "abstract",
        "drop_pattern": r"(?i)^\s*(\*{3}|End\s+of\s+Document)\s*$",
    },
    {
        "source": "bi", "entity": "印度尼西亚", "category": "news_release",
        "base_url": "https://www.bi.go.id", "item": "div.media.media--pers",
        "item_date": "div.media__subtitle", "item_title": "a.media__title",
        "item_link": "a.media__title", "item_abstract": "p.ellipsis--three-line",
        "date_style": "before_bullet", "on_unparsed": "today",
        "containers": "div.page-description | div.col-md-8", "block_tags": "p,h4,table,strong",
        "fallback_chain": "abstract",
    },
    {
        "source": "sama", "entity": "沙特", "category": "news", "base_url": "https://www.sama.gov.sa",
        "item": "li.dfwp-item", "item_date": "div.year.item-date",
        "item_title": "h2.newsitem-title a", "item_link": "h2.newsitem-title a",
        "item_abstract": "div.description.hidden-xs", "date_style": "slash_day_first",
        "on_unparsed": "today",
        "containers": "div.pagecontent div.ms-rtestate-field | div.pagecontent",
        "block_tags": "p,h4,h3,div,strong", "fallback_chain": "abstract",
    },
    {
        "source": "bcra", "needs_date": True, "entity": "阿根廷", "category": "news",
        "base_url": "https://www2.bcra.gob.ar", "directory": "/Noticias/", "item": "tbody tr",
        "item_date": "span.fecha-tabla", "item_title": "a", "item_link": "a",
        "date_style": "slash_month_first", "on_unparsed": "today",
        "containers": "div.clearfix.pagina-interior",
        "block_tags": "h2:first | p.post-pagina-interior", "tight_tags": "h2",
        "abstract_mode": "empty", "fallback_chain": "title",
    },
    {
        "source": "weiyang", "entity": "未央", "category": "international",
        "base_url": "https://www.weiyangx.com", "item": ".wyt-tag-post",
        "item_date": ".wyt-tag-post-info-meta span:first-child", "item_title": "h4",
        "detail_date": ".uk-margin-remove.uk-text-small span",
        "item_link": "a", "item_abstract": ".wyt-tag-post-info-brief", "date_style": "relative",
        "on_unparsed": "today", "containers": ".wyt-single-output", "block_tags": "p,h2,h3",
        "remove": "div[uk-grid],.wyt-single-author,.wyt-single-tag,p[class*=uk-text-small]",
        "tight_tags": "p,h2,h3", "separator": "\n",
        "drop_pattern": r"^(本文共\d+字|预计阅读时间)", "fallback_chain": "abstract",
    },
    {
        "source": "bahamas", "entity": "巴哈马", "category": "news",
        "base_url": "https://www.centralbankbahamas.com", "item": "div.news_box",
        "item_date": "span.dd + span.yy", "item_title": "a.title_div", "item_link": "a.title_div",
        "item_abstract": "div.info_cell > p:not(.category_div)", "date_style": "day_month_abbr",
        "containers": "div.right_content", "block_tags": "h1.cms_detail_h2:first | p",
        "tight_tags": "h1", "fallback_chain": "abstract_title",
    },
    {
        "source": "bdf", "entity": "法国", "category": "search",
        "base_url": "https://www.banque-france.fr", "item": "div.views-row",
        "item_date": "small.text-grey-l6", "item_title": "h3.title",
        "item_link": "a.search-result-card", "item_abstract": "p.card-text",
        "date_style": "ordinal", "containers": "div.rich-text | div.field__item",
        "block_tags": "p,h1,h2,h3,h4,strong", "fallback_chain": "abstract_title",
    },
    {
        "source": "mnb", "entity": "匈牙利", "category": "news", "base_url": "https://www.mnb.hu",
        "item": "li.news-list-item", "item_date": "p.news-list-item-date",
        "item_title": "p.news-list-item-title a", "item_link": "p.news-list-item-title a",
        "date_style": "trailing_dot", "containers": "div.c-ph", "block_tags": "p",
        "abstract_mode": "empty", "fallback_chain": "title",
    },
]

# A rule that suits ordinary article pages, for sources without one of their own.
GENERIC_RULE = {
    "source": "generic", "entity": "generic", "category": "news",
    "item": "nav li", "item_title": "a", "item_link": "a", "take_while": False, "cap": 0,
    "containers": "article | main | body", "block_tags": "h1,h2,h3,h4,p,li,blockquote",
}


def rules_table(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    """Rules as a DataFrame. Nothing is capped unless a rule says so."""
    rows = [{**_DEFAULTS, **r} for r in (SITE_RULES if rules is None else rules)]
    names = [part.split()[0] for part in RULE_SCHEMA.split(", ")]
    # From Arrow the rows become a local relation, whose size the planner knows.
    table = pa.table({n: [r[n] for r in rows] for n in names})
    columns = [f"cast({part.split()[0]} as {part.split()[1]}) as {part.split()[0]}" for part in RULE_SCHEMA.split(", ")]
    return spark.createDataFrame(table).selectExpr(*columns)
