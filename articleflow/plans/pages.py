"""Queries over landed pages and feed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from articleflow.functions.text import clean_one_line
from articleflow.operators import blocks as B
from articleflow.operators.collect import accepted_items, as_articles, entry_articles, listing_position
from articleflow.operators.filters import in_lookback
from articleflow.operators.incremental import first_per_key, new_rows, not_in_history, spread_join
from articleflow.plans import fixtures as X
from articleflow.plans.dates import PLAIN
from articleflow.plans.incremental import one_line
from articleflow.plans.registry import query
from articleflow.session import settle
from articleflow.sources import feeds, pages
from articleflow.sources.rules import GENERIC_RULE, SITE_RULES

ARTICLE_RULE = {**GENERIC_RULE, "source": "pages"}
LINKS = r"<a\s+[^>]*?href=[\"']([^\"']*)[\"']"


def ruled_pages(spark, sf_dir, **changes):
    # A page without an id has no source of its own and is read by the generic rule.
    p = X.table(spark, sf_dir, "pages").withColumn("source", F.when(F.col("page_id").isNotNull(), F.lit("pages")))
    return pages.with_rules(p, [{**ARTICLE_RULE, **changes}])


@query(
    "page_links",
    r"""
    SELECT page_id, CAST(pos AS BIGINT) AS pos, link FROM (
      SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '<a\s+[^>]*?href=["'']([^"'']*)["'']', 1) AS links FROM pages) a) b""",
)
def page_links(spark, sf_dir):
    """The ``href`` part of a listing, without leaving the JVM."""
    links = F.regexp_extract_all(F.col("html"), F.lit(LINKS), F.lit(1))
    return X.table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("pos", "link")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "link"
    )


@query(
    "page_listing",
    f"""
    SELECT page_id, CAST(pos AS BIGINT) AS pos,
           'https://' || 'site.example' || regexp_extract(item, 'href="([^"]*)"', 1) AS link,
           {one_line(PLAIN.replace('(x,', '(title,'))} AS title
    FROM (SELECT page_id, item, pos, regexp_extract(item, '>([^<]*)</a>', 1) AS title FROM (
      SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS items FROM pages) a) b) c""",
)
def page_listing(spark, sf_dir):
    """Navigation entries as a listing with absolute links."""
    items = pages.extract_items(ruled_pages(spark, sf_dir, base_url="https://site.example"))
    done = pages.resolve_items(items, F.lit(X.NOW))
    return done.select("page_id", F.col("pos").cast("bigint").alias("pos"), "link", "title")


# A block runs from its opening tag to its end tag or to the next block's start.
PIECES = f"""
bodies AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages),
split AS (SELECT page_id, regexp_extract_all(body, '<(?:h1|p)>') AS tags,
                 string_split_regex(body, '<(?:h1|p)>')[2:] AS parts FROM bodies),
raw AS (SELECT page_id, unnest(tags) AS tag, unnest(parts) AS part, generate_subscripts(parts, 1) AS no FROM split),
cleaned AS (
  SELECT page_id, no, trim(tag, '<>') AS tag,
         regexp_replace(regexp_replace(part, '(?s)</(?:h1|p)>.*', ''), '<[^>]*>', ' ', 'g') AS x FROM raw),
blocks AS (SELECT page_id, no, tag, {one_line(PLAIN)} AS text FROM cleaned)"""
COUNTED = PIECES + """,
counted AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY no) - 1 AS pos, tag, text
  FROM blocks WHERE text <> '')"""


@query("page_blocks", X.with_sql(COUNTED, "SELECT page_id, pos, tag, text FROM counted"))
def page_blocks(spark, sf_dir):
    done = pages.extract_blocks(ruled_pages(spark, sf_dir))
    return B.block_rows(done, "page_id").select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "tag", clean_one_line(F.col("text")).alias("text")
    )


@query(
    "content_assemble",
    X.with_sql(
        COUNTED,
        f"""
        SELECT p.page_id, coalesce(c.content, '') AS content FROM pages p LEFT JOIN (
          SELECT page_id, {one_line("string_agg(text, ' ' ORDER BY pos)")} AS content FROM counted
          WHERE length(text) > 5 GROUP BY page_id) c ON p.page_id = c.page_id""",
    ),
)
def content_assemble(spark, sf_dir):
    done = B.page_content(pages.extract_blocks(ruled_pages(spark, sf_dir, min_length=6)))
    return done.select("page_id", clean_one_line(F.col("content")).alias("content"))


def lines_as_blocks(spark, sf_dir):
    """Document lines as blocks; a container holds four lines."""
    lines = F.split("content", "\n")
    blocks = F.transform(
        lines,
        lambda t, i: F.struct(
            F.floor(i / 4).cast("int").alias("container"), i.alias("pos"), F.lit("p").alias("tag"), t.alias("text")
        ),
    )
    return X.staged(spark, sf_dir).select("pos", blocks.alias("blocks"))


LINES = X.STAGED + """,
parts AS (SELECT pos, string_split(content, chr(10)) AS lines FROM staged)"""
CONTAINERS = LINES + """,
numbered AS (SELECT pos, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS no FROM parts),
containers AS (
  SELECT pos, no // 4 AS c, trim(string_agg(line, ' ' ORDER BY no), ' ' || chr(9) || chr(10) || chr(13)) AS text
  FROM numbered GROUP BY pos, no // 4)"""


@query(
    "block_filter",
    X.with_sql(
        LINES,
        """
        SELECT pos, len(kept) AS n, array_to_string(kept, chr(10)) AS content FROM (
          SELECT pos, list_filter(lines, lambda t: length(t) >= 20 AND NOT regexp_matches(t, '(?i)^\\s*(the|la) ')) AS kept
          FROM parts) x""",
    ),
)
def block_filter(spark, sf_dir):
    kept = B.keep_blocks(F.col("blocks"), 20, r"(?i)^\s*(the|la) ")
    rows = lines_as_blocks(spark, sf_dir).select("pos", kept.alias("kept"))
    return rows.select("pos", F.size("kept").cast("bigint").alias("n"), B.join_blocks(F.col("kept"), "\n").alias("content"))


@query(
    "block_trim",
    X.with_sql(
        LINES,
        """
        SELECT pos, len(kept) AS n, array_to_string(kept, ' ') AS content FROM (
          SELECT pos, CASE WHEN len(lines) > 5 THEN lines[3:len(lines) - 3] ELSE lines END AS kept FROM parts) x""",
    ),
)
def block_trim(spark, sf_dir):
    rows = lines_as_blocks(spark, sf_dir).select("pos", B.trim_blocks(F.col("blocks")).alias("kept"))
    return rows.select("pos", F.size("kept").cast("bigint").alias("n"), B.join_blocks(F.col("kept"), " ").alias("content"))


@query(
    "longest_container",
    X.with_sql(
        CONTAINERS,
        """
        SELECT pos, text AS content FROM (
          SELECT *, row_number() OVER (PARTITION BY pos ORDER BY length(text) DESC, c) AS n FROM containers) x
        WHERE n = 1""",
    ),
)
def longest_container(spark, sf_dir):
    texts = B.container_texts(F.col("blocks"), " ")
    return lines_as_blocks(spark, sf_dir).select("pos", B.longest_container(texts).alias("content"))


@query(
    "sufficient_container",
    X.with_sql(
        CONTAINERS,
        """
        SELECT pos, coalesce(min_by(text, c) FILTER (WHERE length(text) > 500),
                             max_by(text, c) FILTER (WHERE text <> ''), 'none') AS content
        FROM containers GROUP BY pos""",
    ),
)
def sufficient_container(spark, sf_dir):
    texts = B.container_texts(F.col("blocks"), " ")
    text = B.sufficient_container(texts, F.lit("none"), enough=500)
    return lines_as_blocks(spark, sf_dir).select("pos", text.alias("content"))


def feed_documents(spark, sf_dir):
    """Feed documents of 50 entries each, built from the documents."""

    def escaped(column):
        text = F.replace(column, F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    a = X.staged(spark, sf_dir)
    item = F.concat(
        F.lit("<item><title>"), escaped(F.col("title")), F.lit("</title><link>"),
        F.substring_index("url", ".example.com", -1), F.lit("</link><pubDate>"),
        F.date_format("published_on", "EEE, dd MMM yyyy"), F.lit(" 08:30:00 +0100</pubDate><description>&lt;p&gt;"),
        escaped(F.col("content")), F.lit("&lt;/p&gt;</description></item>"),
    )
    grouped = a.groupBy("source", F.floor(F.col("pos") / 50).alias("no")).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("x")))), lambda i: i["x"]), ""
        ).alias("items")
    )
    return grouped.select(
        F.concat(F.lit("https://"), "source", F.lit(".example.com/feed")).alias("feed_url"), "source",
        F.concat(F.lit("<rss><channel><title>t</title>"), "items", F.lit("</channel></rss>")).alias("xml"),
    )


@query(
    "feed_items",
    X.with_sql(
        X.STAGED,
        f"""
        SELECT 'https://' || source || '.example.com/feed' AS feed_url, {one_line('title')} AS title,
               '/' || category || '/' || CAST(pos % 700 AS VARCHAR) AS link,
               strftime(published_on, '%a, %d %b %Y') || ' 08:30:00 +0100' AS date_raw,
               '<p>' || content || '</p>' AS summary FROM staged""",
    ),
)
def feed_items(spark, sf_dir):
    entries = feeds.feed_entries(feed_documents(spark, sf_dir), "xml")
    return entries.select("feed_url", clean_one_line(F.col("title")).alias("title"), "link", "date_raw", "summary")


@query(
    "feed_registry_join",
    X.with_sql(
        X.STAGED,
        f"""
        SELECT sha256('rss|' || url) AS uid, 'rss' AS source, entity,
               CASE WHEN length(source) = 4 THEN 'news' ELSE source END AS category,
               CAST(published_on AS VARCHAR) || ' 08:30:00' AS published_at, {one_line('title')} AS title,
               url, {one_line('content')} AS abstract, 'html' AS content_type
        FROM staged WHERE published_on >= DATE '2024-01-20'""",
    ),
)
def feed_registry_join(spark, sf_dir):
    """Entries with the attributes of their feed, dated, in the window."""
    docs = feed_documents(spark, sf_dir).select("feed_url", "xml")
    sources = X.table(spark, sf_dir, "documents").select("source").distinct()
    base = F.concat(F.lit("https://"), "source", F.lit(".example.com"))
    registry = sources.select(
        F.upper("source").alias("entity"), F.lit("news").alias("entity_type"),
        F.when(F.length("source") != 4, F.col("source")).alias("rss_type"),
        F.concat(base, F.lit("/feed")).alias("feed_url"), base.alias("base_url"),
    )
    rows = feeds.resolve_entries(feeds.feed_entries(docs, "xml"), registry, 2026)
    kept = rows.filter(in_lookback(F.col("published_on"), X.NOW, days=11))
    return kept.drop("feed_url", "entry_pos", "published_on")


# Listing rows of all sites: the documents, spread over the sites of the rule table, each
# with its date written in its site's way. Every 13th date cannot be read.
LISTED_STYLES = {
    "month_day_year": "MMMM d, yyyy", "numeric": "dd.MM.yyyy", "day_month_year": "dd MMMM yyyy",
    "dotted_month": "MMM'.' d, yyyy", "before_comma": "d MMMM yyyy', x'", "after_label": "'Published Date: 'dd MMM yyyy",
    "before_bullet": "dd MMMM yyyy' • News'", "slash_day_first": "d/M/yyyy", "slash_month_first": "M/d/yyyy",
    "relative": "yyyy.M.d", "day_month_abbr": "dd MMM yyyy", "ordinal": "d'th of 'MMMM yyyy",
    "trailing_dot": "d MMMM yyyy'.'", "feed": "yyyy-MM-dd'T'HH:mm:ss'Z'",
}


def site_items(spark, sf_dir):
    sites = [r["source"] for r in SITE_RULES]
    site = F.get(F.array(*[F.lit(x) for x in sites]), (F.col("pos") % len(sites)).cast("int"))
    s = X.listing(spark, sf_dir).select(
        site.alias("source"), "pos", "title", "published_on",
        F.concat(F.lit("/item/"), (F.col("pos") % 700).cast("string")).alias("raw_link"),
    )
    s = pages.with_rules(s)
    raw = F.lit("soon")
    for style, pattern in LISTED_STYLES.items():
        raw = F.when(F.col("date_style") == style, F.date_format("published_on", pattern)).otherwise(raw)
    blank = F.col("pos") % 19 == 18
    return s.select(
        *[c for c in s.columns if c not in ("published_on", "raw_link", "title", *pages.CONTENT_RULES)],
        F.when(F.col("pos") % 26 == 25, F.lit("")).when(F.col("pos") % 13 == 12, F.lit("soon")).otherwise(raw).alias("date_raw"),
        F.when(blank, F.lit("")).otherwise(F.col("title")).alias("title"), F.lit("").alias("abstract"),
        F.when(F.col("pos") % 23 == 22, F.lit("")).otherwise(F.col("raw_link")).alias("link"),
    )


SITE_VALUES = ", ".join(
    "({}, '{}', '{}', '{}', {}, {}, {}, {}, {}, {}, {}, {}, {})".format(
        i, r["source"], r.get("base_url", "") + r.get("directory", ""), r.get("on_unparsed", "drop"),
        bool(r.get("needs_title")), bool(r.get("date_headers")), r.get("cap", 0),
        r.get("take_while", True) and not r.get("sort_by_date", False),
        bool(r.get("skip_documents")), bool(r.get("drop_known")), r.get("seen_limit", 0),
        bool(r.get("sort_by_date")), bool(r.get("needs_date")),
    )
    for i, r in enumerate(SITE_RULES)
)


@query(
    "site_listing",
    X.with_sql(
        X.LISTING + f""",
        rules(no, site, prefix, on_unparsed, needs_title, date_headers, cap, stops, skip_documents, drop_known, seen_limit, sorted, needs_date) AS (VALUES {SITE_VALUES}),
        raw AS (
          SELECT site AS source, pos, CASE WHEN pos % 19 = 18 THEN '' ELSE title END AS title,
                 CASE WHEN pos % 23 = 22 THEN '' ELSE prefix || '/item/' || CAST(pos % 700 AS VARCHAR) END AS link,
                 CASE WHEN pos % 13 = 12 THEN NULL ELSE published_on END AS day, r.* EXCLUDE (site)
          FROM listing JOIN rules r ON r.no = pos % {len(SITE_RULES)}),
        stored AS (
          SELECT pos, prefix FROM listing JOIN rules r ON r.no = pos % {len(SITE_RULES)}
          WHERE published_on < DATE '2024-01-29'),
        -- An entry without a link is a date header where a site has them.
        headed AS (
          SELECT *, count(*) FILTER (WHERE date_headers AND link = '') OVER (PARTITION BY source ORDER BY pos) AS grp FROM raw),
        filled AS (
          SELECT *, CASE WHEN NOT date_headers THEN day WHEN grp = 0 THEN NULL
                         ELSE first_value(day) OVER (PARTITION BY source, grp ORDER BY pos) END AS d FROM headed),
        dated AS (
          SELECT *, CASE WHEN d IS NULL AND on_unparsed = 'today' THEN DATE '2024-01-31' ELSE d END AS published_on
          FROM filled WHERE link <> '' AND (NOT needs_title OR title <> '') AND NOT (needs_date AND pos % 26 = 25)
            AND NOT (skip_documents AND regexp_matches(lower(title), 'annex|attachment|chart|figure|table'))),
        kept AS (SELECT * FROM dated WHERE published_on IS NOT NULL OR on_unparsed = 'keep_raw'),
        once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, link ORDER BY CASE WHEN sorted THEN published_on END DESC NULLS LAST, pos) AS n FROM kept) x WHERE n = 1),
        scanned AS (
          SELECT *, published_on IS NULL OR published_on >= DATE '2024-01-28' AS recent,
                 min(CASE WHEN published_on IS NULL OR published_on >= DATE '2024-01-28' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY source ORDER BY pos) AS before_stop FROM once),
        seen AS (
          SELECT *, link IN (SELECT prefix || '/item/' || CAST(pos % 700 AS VARCHAR) FROM stored) AS known
          FROM scanned WHERE recent AND (NOT stops OR before_stop = 1)),
        islands AS (
          SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY pos) AS island FROM seen),
        runs AS (
          SELECT *, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY pos) AS run
          FROM islands),
        cuts AS (SELECT source, min(pos) AS cut FROM runs WHERE known AND run >= seen_limit AND seen_limit > 0 GROUP BY source),
        unknown AS (
          SELECT s.* FROM seen s LEFT JOIN cuts c ON s.source = c.source
          WHERE NOT (drop_known AND known) AND (c.cut IS NULL OR s.pos < c.cut)),
        accepted AS (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos) AS place FROM unknown)""",
        """
        SELECT source, pos, link, CAST(published_on AS VARCHAR) AS published_at FROM accepted
        WHERE cap = 0 OR place <= cap""",
    ),
)
def site_listing(spark, sf_dir):
    """Every site's listing rules in one plan, over all documents as listed items."""
    items = settle(pages.resolve_items(site_items(spark, sf_dir), F.lit(X.NOW)), "site-items")
    stored = X.listing(spark, sf_dir).filter(F.col("published_on") < F.lit("2024-01-29").cast("date"))
    number = (F.col("pos") % len(SITE_RULES)).cast("int")
    prefixes = F.array(*[F.lit(r.get("base_url", "") + r.get("directory", "")) for r in SITE_RULES])
    known = stored.select(
        F.concat(F.get(prefixes, number), F.lit("/item/"), (F.col("pos") % 700).cast("string")).alias("url")
    )
    done = accepted_items(items, X.NOW, days=3, history=known)
    return done.select("source", "pos", "link", F.col("published_on").cast("string").alias("published_at"))


# List pages that show their items as lines: a date, sometimes a category, sometimes a marked title.
SHOWN = X.STAGED + f""",
shown AS (
  SELECT pos, floor(pos / 40) AS page_no, {one_line('title')} AS name, published_on, upper(source) AS entity,
         CASE WHEN pos % 7 = 3 THEN 'Foo. 45, 2024' WHEN pos % 11 = 5 THEN '+ Jan. 5, 2024'
              ELSE strftime(published_on, '%b. %-d, %Y') END AS date_line FROM staged),
listed AS (
  SELECT *, lead(date_line) OVER (PARTITION BY page_no ORDER BY pos) AS next_date FROM shown)"""


@query(
    "boj_listing",
    X.with_sql(
        SHOWN,
        """
        SELECT CAST(page_no AS BIGINT) AS page_no, CAST(published_on AS VARCHAR) AS published_at,
               CASE WHEN pos % 9 = 8 THEN coalesce(next_date, '') WHEN pos % 5 = 4 THEN entity || ' announcements' ELSE trim(name || ' [PDF 10KB]') END AS title,
               CASE WHEN pos % 9 = 8 THEN '' WHEN pos % 5 = 4 THEN 'https://www.boj.or.jp/en/about/' || CAST(pos AS VARCHAR)
                    ELSE 'https://www.boj.or.jp/en/data/' || CAST(pos AS VARCHAR) || '.pdf' END AS link,
               CASE WHEN pos % 9 = 8 THEN '' ELSE entity || ' announcements' END AS category
        FROM listed WHERE pos % 7 <> 3 AND pos % 11 <> 5""",
    ),
)
def boj_listing(spark, sf_dir):
    """A site without item elements: lines of text, cut at the dates, each title with its own link."""

    def shown(text):
        return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    s = X.staged(spark, sf_dir)
    no, number = F.col("pos"), F.col("pos").cast("string")
    day = F.when(no % 7 == 3, "Foo. 45, 2024").when(no % 11 == 5, "+ Jan. 5, 2024").otherwise(F.date_format("published_on", "MMM. d, yyyy"))
    about = F.concat(F.lit('<p><a href="/en/about/'), number, F.lit('">'), F.upper("source"), F.lit(" </a><b>announcements</b></p>"))
    paper = F.concat(F.lit('<div>\n<span><a href="/en/data/'), number, F.lit('.pdf">'), shown(F.col("title")), F.lit(" [PDF <i>10KB]</i></a></span></div>"))
    body = F.when(no % 9 == 8, "").when(no % 5 == 4, about).otherwise(F.concat(about, paper))
    item = F.concat(F.lit("<tr><td>"), day, F.lit("</td></tr><tr><td>"), body, F.lit("</td></tr>"))
    lists = s.groupBy(F.floor(no / 40).alias("page_no")).agg(F.sort_array(F.collect_list(F.struct("pos", item.alias("x")))).alias("rows"))
    html = F.concat(F.lit("<head><title>May. 1, 2024</title></head><body><h1>What's new</h1><table>"), F.array_join(F.transform("rows", lambda r: r["x"]), ""), F.lit("</table>"))
    listed = pages.with_rules(lists.select("page_no", F.when(F.size("rows") > 0, "boj").alias("source"), html.alias("html")))
    items = pages.resolve_items(pages.line_items(listed, ["page_no"]), F.lit(X.NOW)).filter(F.col("published_on").isNotNull())
    return items.select("page_no", F.col("published_on").cast("string").alias("published_at"), "title", "link", "category")


@query(
    "new_page_content",
    X.with_sql(
        COUNTED,
        f"""
        SELECT p.page_id, p.url, coalesce(c.content, '') AS content FROM pages p LEFT JOIN (
          SELECT page_id, {one_line("string_agg(text, ' ' ORDER BY pos)")} AS content FROM counted GROUP BY page_id) c
          ON p.page_id = c.page_id
        WHERE p.url NOT IN (SELECT url FROM pages WHERE length(html) > 3000)""",
    ),
)
def new_page_content(spark, sf_dir):
    """Known links leave before any page is walked: here those of the long pages."""
    p = ruled_pages(spark, sf_dir)
    known = X.table(spark, sf_dir, "pages").filter(F.length("html") > 3000).select("url")
    fresh = not_in_history(p, known, "page_id", by="url")
    done = B.page_content(pages.extract_blocks(fresh))
    return done.select("page_id", "url", clean_one_line(F.col("content")).alias("content"))


@query(
    "page_articles",
    X.with_sql(
        COUNTED,
        f"""
        SELECT sha256('pages|' || p.url) AS uid, 'pages' AS source, 'generic' AS entity, 'news' AS category,
               '2024-01-31' AS published_at, CAST(p.page_id AS VARCHAR) AS title, p.url, '' AS abstract,
               coalesce(c.content, '') AS content
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM pages WHERE url <> '') p LEFT JOIN (
          SELECT page_id, {one_line("string_agg(text, ' ' ORDER BY pos)")} AS content FROM counted GROUP BY page_id) c
          ON p.page_id = c.page_id
        WHERE p.n = 1 AND p.url NOT IN (SELECT url FROM pages WHERE length(html) > 3000)""",
    ),
)
def page_articles(spark, sf_dir):
    """From landed list pages to new articles: links, known ones out, pages, rows to load.

    The list pages name all pages of the table, fifty on each; only pages that are still
    wanted are walked.
    """
    p = X.table(spark, sf_dir, "pages").filter("url <> ''")
    rule = {**ARTICLE_RULE, "on_unparsed": "today"}
    link = F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    entry = F.concat(F.lit('<li><a href="'), link, F.lit('">'), F.col("page_id").cast("string"), F.lit("</a></li>"))
    lists = p.groupBy(F.floor(F.col("page_id") / 50).alias("page_no")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", entry.alias("x")))), lambda e: e["x"]), "").alias("items")
    )
    html = F.concat(F.lit("<nav><ul>"), "items", F.lit("</ul></nav>")).alias("html")
    listed = pages.with_rules(lists.select("page_no", F.when(F.col("page_no") >= 0, F.lit("pages")).alias("source"), html), [rule])
    items = pages.resolve_items(pages.extract_items(listed), F.lit(X.NOW))
    items = items.withColumn("pos", listing_position(F.col("page_no"), F.col("pos")))
    accepted = accepted_items(settle(items, "listed"), X.NOW).withColumn("url", F.col("link"))
    known = X.table(spark, sf_dir, "pages").filter(F.length("html") > 3000).select("url")
    fresh = settle(not_in_history(accepted, known, "pos", by="url"), "fresh")
    first = first_per_key(p, F.col("url"), "page_id").select("url", "html", F.lit("pages").alias("_site"))
    wanted = spread_join(first, fresh.select("url").distinct(), ["url"], "left_semi").withColumnRenamed("_site", "source")
    walked = B.page_content(pages.extract_blocks(pages.with_rules(wanted.withColumn("source", F.when(F.col("url") != "", F.col("source"))), [rule])))
    rows = as_articles(spread_join(fresh, walked.select("url", "content"), ["url"], "left"), F.lit("2024-01-31 08:00:00"))
    new = new_rows(rows, X.history(spark, sf_dir), "pos")
    return new.select("uid", "source", "entity", "category", "published_at", "title", "url", "abstract", "content")


@query(
    "feed_articles",
    X.with_sql(
        COUNTED,
        f"""
        SELECT sha256('rss|' || p.url) AS uid, 'rss' AS source, 'Pages' AS entity, 'news' AS category, '2024-01-31 08:30:00' AS published_at,
               'Page ' || CAST(p.page_id AS VARCHAR) AS title, p.url, 'short' AS abstract, coalesce(c.content, '') AS content
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM pages WHERE url <> '' AND page_id IS NOT NULL) p LEFT JOIN (
          SELECT url, {one_line("string_agg(text, ' ' ORDER BY pos)")} AS content
          FROM counted JOIN (SELECT url, page_id, row_number() OVER (PARTITION BY url ORDER BY html) AS m FROM pages) l USING (page_id)
          WHERE m = 1 AND length(text) > 5 GROUP BY url) c ON p.url = c.url
        WHERE p.n = 1 AND p.page_id % 3 <> 0 AND p.url NOT IN (SELECT url FROM pages WHERE length(html) > 3000)""",
    ),
)
def feed_articles(spark, sf_dir):
    """From feed entries to stored articles: window, known ones out, then the page behind each entry.

    The feeds name all pages of the table; every third entry is too old.
    """
    p = X.table(spark, sf_dir, "pages").filter("url <> '' and page_id is not null")
    link = F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    day = F.when(F.col("page_id") % 3 == 0, "Mon, 01 Jan 2024").otherwise("Wed, 31 Jan 2024")
    entry = F.concat(
        F.lit("<item><title>Page "), F.col("page_id").cast("string"), F.lit("</title><link>"), link, F.lit("</link><pubDate>"), day,
        F.lit(" 08:30:00 +0100</pubDate><description>&lt;p&gt;short&lt;/p&gt;</description></item>"),
    )
    grouped = p.groupBy(F.floor(F.col("page_id") / 50).alias("feed_no")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", entry.alias("x")))), lambda e: e["x"]), "").alias("items")
    )
    feed = F.lit("https://pages.example.com/feed")
    docs = grouped.select(feed.alias("feed_url"), "feed_no", F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")).alias("xml"))
    names = "entity string, entity_type string, rss_type string, feed_url string, base_url string"
    registry = spark.createDataFrame([("Pages", "news", "", "https://pages.example.com/feed", "")], names)
    resolved = feeds.resolve_entries(feeds.feed_entries(docs, "xml"), registry, 2024)
    placed = resolved.withColumn("pos", listing_position(F.col("feed_no"), F.col("entry_pos")))
    recent = settle(placed.filter(in_lookback(F.col("published_on"), X.NOW)), "recent")
    known = X.table(spark, sf_dir, "pages").filter(F.length("html") > 3000).select("url")
    fresh = settle(new_rows(recent, known, "pos", "url"), "fresh")
    rows = entry_articles(fresh, X.table(spark, sf_dir, "pages"), F.lit("2024-01-31 08:00:00"))
    return rows.select("uid", "source", "entity", "category", "published_at", "title", "url", "abstract", "content")
