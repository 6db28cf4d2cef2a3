"""Queries over batches and the history."""

from __future__ import annotations

from pyspark.sql import functions as F

from articleflow.functions.text import WS, WS_CHARS, ZERO_WIDTH
from articleflow.operators import filters as P
from articleflow.operators import incremental as I
from articleflow.operators.report import source_summary as summary
from articleflow.plans import fixtures as X
from articleflow.plans.registry import query
from articleflow.schema import ARTICLE_FIELDS, VERDICT_FIELDS
from articleflow.session import work_dir
from articleflow.sources import articles as A
from articleflow.sources import tables
from articleflow.sources.rules import SITE_RULES, rules_table
from articleflow.streaming.ingest import ingest, load_batch


def one_line(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '[{WS}{ZERO_WIDTH}]+', ' ', 'g'))"


def multi_line(x: str) -> str:
    s = f"regexp_replace(coalesce({x}, ''), '[{ZERO_WIDTH}]+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\r\\n?', chr(10), 'g')"
    s = f"regexp_replace({s}, '\\n[{WS}]*\\n', chr(10) || chr(10), 'g')"
    return f"trim({s}, '{WS_CHARS}')"


def canonical_sql(frame: str, extra: str = "") -> str:
    cleaned = ", ".join(
        f"{(multi_line if n in ('title', 'abstract', 'content') else one_line)(n)} AS {n}"
        for n in ("uid", "source", "entity", "category", "published_at", "title", "url", "abstract", "content")
    )
    return (
        f"SELECT pos, {cleaned}, '' AS content_type, '' AS crawl_time, '' AS is_relevant "
        f"FROM {frame} {extra}"
    )


DIRTY = X.ARTICLES + """,
dirty AS (
  SELECT * REPLACE (
    chr(8203) || chr(9) || replace(title, ' ', chr(8203) || ' ') || chr(160) AS title,
    replace(content, chr(10), chr(13) || chr(10) || chr(9) || chr(13) || chr(10)) || chr(12288) AS content,
    chr(9) || source || chr(8232) AS source) FROM articles)"""


@query("canonicalize", X.with_sql(DIRTY, canonical_sql("dirty")))
def canonicalize(spark, sf_dir):
    a = X.articles(spark, sf_dir)
    dirty = a.withColumns(
        {
            "title": F.concat(
                F.lit("​\t"), F.replace("title", F.lit(" "), F.lit("​ ")), F.lit(" ")
            ),
            "content": F.concat(
                F.replace("content", F.lit("\n"), F.lit("\r\n\t\r\n")), F.lit("　")
            ),
            "source": F.concat(F.lit("\t"), "source", F.lit(" ")),
        }
    )
    return I.canonicalize(dirty, keep=["pos"])


@query("make_uid", X.with_sql(X.ARTICLES, "SELECT pos, uid FROM articles"))
def uid(spark, sf_dir):
    return X.articles(spark, sf_dir).select("pos", "uid")


@query(
    "lookback_filter",
    X.with_sql(X.ARTICLES, "SELECT pos, published_at FROM articles WHERE published_on >= DATE '2024-01-30'"),
)
def lookback_filter(spark, sf_dir):
    return P.lookback(X.articles(spark, sf_dir), X.NOW).select("pos", "published_at")


@query(
    "undated_policy",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, policy AS on_unparsed, CAST(d AS VARCHAR) AS published_at FROM (
          SELECT pos, policy, CASE WHEN raw IS NULL AND policy = 'today' THEN DATE '2024-01-31' ELSE raw END AS d
          FROM (SELECT pos, CASE WHEN pos % 5 = 0 THEN NULL ELSE published_on END AS raw,
                       CASE pos % 3 WHEN 0 THEN 'drop' WHEN 1 THEN 'today' ELSE 'keep_raw' END AS policy
                FROM staged) x) y
        WHERE d >= DATE '2024-01-30' OR (d IS NULL AND policy = 'keep_raw')""",
    ),
)
def undated_policy(spark, sf_dir):
    p = F.col("pos")
    s = X.staged(spark, sf_dir).select(
        "pos", F.when(p % 5 != 0, F.col("published_on")).alias("published_on"),
        F.when(p % 3 == 0, "drop").when(p % 3 == 1, "today").otherwise("keep_raw").alias("on_unparsed"),
    )
    return P.apply_undated_policy(s, X.NOW).select(
        "pos", "on_unparsed", F.col("published_on").cast("string").alias("published_at")
    )


@query(
    "required_fields",
    X.with_sql(
        X.STAGED,
        "SELECT pos, title, url FROM staged WHERE pos % 9 <> 0 AND pos % 11 <> 0 AND title <> ''",
    ),
)
def required_fields(spark, sf_dir):
    s = X.staged(spark, sf_dir).select(
        "pos", F.when(F.col("pos") % 9 == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
        F.when(F.col("pos") % 11 != 0, F.col("url")).alias("url"),
    )
    return P.required_fields(s, ["title", "url"])


@query(
    "skip_links",
    X.with_sql(
        X.STAGED,
        r"""
        SELECT pos, url, title FROM (
          SELECT pos, url || CASE pos % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.XLSX' WHEN 2 THEN '.pdf.html'
                                  WHEN 3 THEN '.zip' ELSE '' END AS url,
                 CASE WHEN pos % 7 = 0 THEN 'Annex ' || title ELSE title END AS title FROM staged) s
        WHERE NOT regexp_matches(lower(url), '\.(pdf|xlsx|xls|doc|docx|zip|rar)$')
          AND NOT regexp_matches(lower(title), 'annex|attachment|chart|figure|table')""",
    ),
)
def skip_links(spark, sf_dir):
    m = F.col("pos") % 6
    ext = F.when(m == 0, ".pdf").when(m == 1, ".XLSX").when(m == 2, ".pdf.html").when(m == 3, ".zip")
    s = X.staged(spark, sf_dir).select(
        "pos", F.concat("url", F.coalesce(ext, F.lit(""))).alias("url"),
        F.when(F.col("pos") % 7 == 0, F.concat(F.lit("Annex "), "title")).otherwise(F.col("title")).alias("title"),
    )
    return P.skip_links(s)


@query(
    "source_selection",
    X.with_sql(
        X.STAGED,
        "SELECT pos, source FROM staged WHERE source IN ('src1', 'src3', 'src5', 'src7', 'src11')"
        " AND source NOT IN ('src3', 'unknown')",
    ),
)
def source_selection(spark, sf_dir):
    s = X.staged(spark, sf_dir).select("pos", "source")
    return P.select_sources(s, ["src1", "src3", "src5", "src7", "src11"], ["src3", "unknown"])


RULE_VALUES = ", ".join(
    f"({i}, '{r['source']}', '{r['entity']}', '{r['category']}', '{r.get('abstract_mode', 'listing')}', "
    f"'{r.get('fallback_chain', '')}')"
    for i, r in enumerate(SITE_RULES)
)
RULED = X.STAGED + f""",
rules(no, site, site_entity, site_category, abstract_mode, fallback_chain) AS (VALUES {RULE_VALUES}),
ruled AS (SELECT s.*, r.* FROM staged s JOIN rules r ON r.no = s.pos % {len(SITE_RULES)})"""


def ruled(spark, sf_dir):
    """Staged articles spread over the sites of the rule table."""
    names = F.array(*[F.lit(r["source"]) for r in SITE_RULES])
    s = X.staged(spark, sf_dir).withColumn(
        "site", F.get(names, (F.col("pos") % len(SITE_RULES)).cast("int"))
    )
    rules = rules_table(spark).select(
        F.col("source").alias("site"), F.col("entity").alias("site_entity"),
        F.col("category").alias("site_category"), "abstract_mode", "fallback_chain",
    )
    return s.join(rules, "site")


@query(
    "source_attributes",
    X.with_sql(
        RULED,
        """
        SELECT pos, site, site_entity AS entity,
               CASE WHEN pos % 3 = 0 THEN site_category ELSE category END AS category FROM ruled""",
    ),
)
def source_attributes(spark, sf_dir):
    item = F.when(F.col("pos") % 3 == 0, F.lit(" \t ")).otherwise(F.col("category"))
    return ruled(spark, sf_dir).select(
        "pos", "site", F.col("site_entity").alias("entity"),
        P.category_or_default(item, F.col("site_category")).alias("category"),
    )


@query(
    "abstract_prefix",
    X.with_sql(
        RULED,
        f"""
        SELECT pos, CASE abstract_mode WHEN 'listing' THEN {one_line('abstract')}
          WHEN 'prefix300' THEN {one_line('substring(content, 1, 300)')}
          WHEN 'prefix5000' THEN {one_line('substring(content, 1, 5000)')} ELSE '' END AS abstract
        FROM ruled""",
    ),
)
def abstract_prefix(spark, sf_dir):
    c = F.col
    return ruled(spark, sf_dir).select(
        "pos", P.derived_abstract(c("abstract_mode"), c("abstract"), c("content")).alias("abstract")
    )


@query(
    "content_fallback",
    X.with_sql(
        RULED,
        f"""
        SELECT pos, CASE WHEN pos % 2 = 1 THEN content
          WHEN fallback_chain = 'abstract' THEN {one_line("CASE WHEN pos % 3 = 0 THEN '' ELSE abstract END")}
          WHEN fallback_chain = 'abstract_title'
            THEN {one_line("CASE WHEN pos % 3 = 0 THEN title ELSE abstract END")}
          WHEN fallback_chain = 'title' THEN {one_line('title')} ELSE '' END AS content
        FROM ruled""",
    ),
)
def content_fallback(spark, sf_dir):
    r = ruled(spark, sf_dir)
    content = F.when(F.col("pos") % 2 == 1, F.col("content"))
    abstract = F.when(F.col("pos") % 3 != 0, F.col("abstract"))
    return r.select(
        "pos", P.content_fallback(F.col("fallback_chain"), content, abstract, F.col("title")).alias("content")
    )


FIRST = """
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos) AS n
                         FROM {frame}) x WHERE n = 1)"""


@query("batch_dedupe", X.with_sql(X.ARTICLES + "," + FIRST.format(frame="articles"), "SELECT pos, uid, url FROM first"))
def batch_dedupe(spark, sf_dir):
    a = X.articles(spark, sf_dir)
    return I.first_per_key(a, F.col("uid"), "pos").select("pos", "uid", "url")


@query(
    "listing_dedupe",
    X.with_sql(
        X.LISTING,
        """
        SELECT source, pos, url FROM (
          SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY pos) AS n FROM listing) x
        WHERE n = 1""",
    ),
)
def listing_dedupe(spark, sf_dir):
    return I.first_link_per_source(X.listing(spark, sf_dir), "source", "url", "pos").select(
        "source", "pos", "url"
    )


@query(
    "antijoin_uid",
    X.with_sql(X.ARTICLES, "SELECT pos, uid FROM articles WHERE uid NOT IN (SELECT uid FROM history)"),
)
def antijoin_uid(spark, sf_dir):
    a, h = X.articles(spark, sf_dir), X.history(spark, sf_dir)
    return I.not_in_history(a, h, "pos").select("pos", "uid")


@query(
    "antijoin_url",
    X.with_sql(
        X.ARTICLES,
        "SELECT pos, url FROM articles WHERE pos % 10 = 0 OR url NOT IN (SELECT url FROM history)",
    ),
)
def antijoin_url(spark, sf_dir):
    # Every tenth link is blank: a row without a key is never dropped.
    a = X.articles(spark, sf_dir).withColumn("raw_url", F.col("url")).withColumn(
        "url", F.when(F.col("pos") % 10 != 0, F.col("url")).otherwise(F.lit(""))
    )
    kept = I.not_in_history(a, X.history(spark, sf_dir), "pos", by="url")
    return kept.select("pos", F.col("raw_url").alias("url"))


RECENT_NEW = X.ARTICLES + """,
recent AS (SELECT * FROM articles WHERE published_on >= DATE '2024-01-30')""" + "," + FIRST.format(
    frame="recent"
) + """,
fresh AS (SELECT * FROM first WHERE uid NOT IN (SELECT uid FROM history))"""


@query("incremental_load", X.with_sql(RECENT_NEW, canonical_sql("fresh")))
def incremental_load(spark, sf_dir):
    return load_batch(X.articles(spark, sf_dir), X.history(spark, sf_dir), X.NOW, "pos")


@query(
    "union_sources",
    X.with_sql(
        X.STAGED + """,
        jobs AS (
          SELECT 0 AS source_order, pos, source, url FROM staged
          UNION ALL SELECT 1, pos, upper(source), url FROM staged
          UNION ALL SELECT 2, page_id, 'page', url FROM pages)""",
        """
        SELECT CAST(source_order AS BIGINT) AS source_order, pos, source, url FROM (
          SELECT *, row_number() OVER (PARTITION BY lower(source), url ORDER BY source_order, pos) AS n
          FROM jobs) x WHERE n = 1""",
    ),
)
def union_sources(spark, sf_dir):
    s = X.staged(spark, sf_dir).select("pos", "source", "url")
    pages = X.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("pos"), F.lit("page").alias("source"), "url"
    )
    reposts = s.withColumn("source", F.upper("source"))
    every = I.union_sources([("articles", s), ("reposts", reposts), ("pages", pages)])
    key = F.concat(F.lower("source"), F.lit("|"), "url")
    return I.first_per_key(every, key, "batch_pos").select("source_order", "pos", "source", "url")


@query(
    "source_summary",
    X.with_sql(
        RECENT_NEW,
        """
        SELECT source, count(*) AS total_collected,
               count(*) FILTER (WHERE pos IN (SELECT pos FROM fresh)) AS new_items
        FROM recent GROUP BY source""",
    ),
)
def source_summary(spark, sf_dir):
    a, h = X.articles(spark, sf_dir), X.history(spark, sf_dir)
    recent = P.lookback(a.select("pos", "source", "uid", "published_on"), X.NOW)
    return summary(recent, I.new_rows(recent, h, "pos"))


@query(
    "history_writeback",
    X.with_sql(
        X.ARTICLES + """,
        batch AS (
          SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos DESC) AS n FROM articles
          WHERE published_on >= DATE '2024-01-10')""",
        """
        SELECT h.pos, h.uid, 
               CASE WHEN b.pos IS NULL OR b.pos % 4 = 0 THEN 'OLD' WHEN b.pos % 4 = 1 THEN 'TRUE' ELSE 'FALSE' END AS is_relevant,
               CASE WHEN b.pos IS NULL THEN '' ELSE 'True' END AS m1_is_relevant,
               CASE WHEN b.pos IS NULL THEN '' ELSE 'from ' || CAST(b.pos AS VARCHAR) END AS m1_reason,
               CASE WHEN b.pos IS NULL THEN '' ELSE 'None' END AS m2_is_relevant,
               CASE WHEN b.pos IS NULL THEN '' ELSE 'Parse Error' END AS m2_reason
        FROM history h LEFT JOIN batch b ON h.uid = b.uid AND b.n = 1""",
    ),
)
def history_writeback(spark, sf_dir):
    h = X.history(spark, sf_dir).select(
        "pos", "uid", F.lit("OLD").alias("is_relevant"), *[F.lit("").alias(c) for c in VERDICT_FIELDS[1:]]
    )
    a = X.articles(spark, sf_dir).filter(F.col("published_on") >= F.lit("2024-01-10").cast("date"))
    m = F.col("pos") % 4
    b = a.select(
        "pos", "uid", F.when(m == 1, F.lit("TRUE")).when(m > 1, F.lit("FALSE")).alias("is_relevant"),
        F.lit("True").alias("m1_is_relevant"),
        F.concat(F.lit("from "), F.col("pos").cast("string")).alias("m1_reason"),
        F.lit("None").alias("m2_is_relevant"), F.lit("Parse Error").alias("m2_reason"),
    )
    return I.write_back(h, b, "pos", VERDICT_FIELDS).select("pos", "uid", *VERDICT_FIELDS)


@query(
    "backfill_candidates",
    X.with_sql(
        X.GAPPY,
        """
        SELECT pos, url FROM articles WHERE url IN (SELECT url FROM gappy WHERE content = '')
        ORDER BY pos LIMIT 20""",
    ),
)
def backfill_candidates(spark, sf_dir):
    listed = X.staged(spark, sf_dir).select("pos", "url")
    return I.backfill_candidates(listed, X.gappy_history(spark, sf_dir), "pos")


@query(
    "backfill_apply",
    X.with_sql(
        X.GAPPY + """,
        updates AS (
          SELECT * FROM (SELECT url, abstract, content, row_number() OVER (PARTITION BY url ORDER BY pos) AS n
                         FROM articles WHERE published_on >= DATE '2024-01-10') u WHERE n = 1)""",
        """
        SELECT g.pos, g.url, CASE WHEN g.content <> '' THEN g.content ELSE coalesce(u.content, '') END AS content
        FROM gappy g LEFT JOIN updates u ON g.url = u.url""",
    ),
)
def backfill_apply(spark, sf_dir):
    a = X.articles(spark, sf_dir)
    updates = a.filter(F.col("published_on") >= F.lit("2024-01-10").cast("date"))
    done = I.apply_backfill(
        X.gappy_history(spark, sf_dir), updates.select("pos", "url", "abstract", "content"), "pos"
    )
    return done.select("pos", "url", "content")


@query(
    "schema_align",
    X.with_sql(
        X.ARTICLES,
        """
        SELECT uid, source, entity, category, published_at, title, url, abstract, content,
               '' AS content_type, '' AS crawl_time, '' AS is_relevant, '' AS m1_is_relevant,
               '' AS m1_reason, '' AS m2_is_relevant, '' AS m2_reason FROM history
        UNION ALL
        SELECT uid, source, entity, category, '', title, url, '', '', 'html', '', 'TRUE', 'True', '', '', ''
        FROM articles""",
    ),
)
def schema_align(spark, sf_dir):
    """Two layouts of the history read as one; neither resets the other."""
    older = X.history(spark, sf_dir)
    newer = X.articles(spark, sf_dir).select(
        "uid", "source", "entity", "category", "title", "url", F.lit("html").alias("content_type"),
        F.lit("TRUE").alias("is_relevant"), F.lit("True").alias("m1_is_relevant"),
    )
    return I.align_columns(older).unionByName(I.align_columns(newer))


@query(
    "pending_runs",
    X.with_sql(
        X.ARTICLES,
        """
        SELECT DISTINCT published_at AS run_date FROM articles
        WHERE published_at NOT IN (SELECT published_at FROM history)""",
    ),
)
def pending_runs(spark, sf_dir):
    run_date = F.col("published_at").alias("run_date")
    requested = X.articles(spark, sf_dir).select(run_date).distinct()
    return I.pending_runs(requested, X.history(spark, sf_dir).select(run_date))


@query(
    "corpus_defaults",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE WHEN pos % 3 = 0 THEN '' ELSE title END AS title, '' AS abstract, content,
               CASE WHEN pos % 5 = 0 THEN '' ELSE url END AS url,
               CASE WHEN pos % 2 = 0 THEN 'Source' ELSE entity END AS entity FROM staged""",
    ),
)
def corpus_defaults(spark, sf_dir):
    p = F.col("pos")
    s = X.staged(spark, sf_dir).select(
        "pos", F.when(p % 3 != 0, F.col("title")).alias("title"), "content",
        F.when(p % 5 != 0, F.col("url")).alias("url"), F.when(p % 2 != 0, F.col("entity")).alias("entity"),
    )
    return A.with_corpus_defaults(s)


@query("article_scan", X.with_sql(X.ARTICLES, canonical_sql("articles").replace("SELECT pos, ", "SELECT ", 1)))
def article_scan(spark, sf_dir):
    """Articles written as quoted CSV with line breaks inside fields, and read back."""
    path = work_dir(spark, "article-scan")
    rows = I.canonicalize(X.articles(spark, sf_dir)).select(*ARTICLE_FIELDS)
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return A.read_articles(spark, path)


@query(
    "batch_validation",
    X.with_sql(
        X.STAGED,
        """
        SELECT count(*) AS rows, count(*) FILTER (WHERE pos % 7 IN (3, 5)) AS malformed,
               min(pos) FILTER (WHERE pos % 7 IN (3, 5)) AS first_bad FROM staged""",
    ),
)
def batch_validation(spark, sf_dir):
    """CSV records of three columns; some have one less, some one more."""

    def quoted(name):
        return F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))

    m = F.col("pos") % 7
    line = (
        F.when(m == 3, F.concat_ws(",", quoted("source"), quoted("content")))
        .when(m == 5, F.concat_ws(",", quoted("source"), quoted("url"), quoted("content"), quoted("url")))
        .otherwise(F.concat_ws(",", quoted("source"), quoted("url"), quoted("content")))
    )
    lines = X.staged(spark, sf_dir).select("pos", line.alias("line"))
    return A.validate_lines(lines, "line", "pos", 3)


@query("stream_ingest", X.with_sql(RECENT_NEW, canonical_sql("fresh").replace("SELECT pos, ", "SELECT ", 1)))
def stream_ingest(spark, sf_dir):
    """The documents as a stream of several files into a history of several loads."""
    root = work_dir(spark, "stream-ingest")
    stored = X.history(spark, sf_dir)
    half = F.col("pos") % 2 == 0
    tables.write_load(stored.filter(half), f"{root}/history", 0)
    tables.write_load(stored.filter(~half), f"{root}/history", 42)
    documents = X.table(spark, sf_dir, "documents")
    place = F.col("doc_id")
    cuts = documents.approxQuantile("doc_id", [0.3, 0.7], 0.01) or [0.0, 0.0]
    # Earlier rows land first, so the first of repeated rows wins; a row without id lands last.
    third = F.when(place < cuts[0], 0).when(place < cuts[1], 1).otherwise(2)
    for part in range(3):
        documents.filter(third == part).write.mode("append").parquet(f"{root}/landing")
        raw = spark.readStream.schema(documents.schema).parquet(f"{root}/landing")
        ingest(X.as_articles(raw), f"{root}/history", f"{root}/checkpoint", "pos", lambda batch_id: X.NOW).awaitTermination()
    return tables.read_history(spark, f"{root}/history").filter(F.col("run_id") != tables.LOADS).select(*ARTICLE_FIELDS)


@query("batch_table", X.with_sql(RECENT_NEW, canonical_sql("fresh").replace("SELECT pos, ", "SELECT ", 1)))
def batch_table(spark, sf_dir):
    """The new batch of a run date, written, replaced by a second run, and read back."""
    path = work_dir(spark, "batch-table")
    rows = load_batch(X.articles(spark, sf_dir), X.history(spark, sf_dir), X.NOW, "pos")
    tables.write_batch(rows.filter("pos % 2 = 0"), path, "2024-01-31")
    tables.write_batch(rows, path, "2024-01-31")
    return spark.read.parquet(path).select(*ARTICLE_FIELDS)


@query(
    "header_check",
    X.with_sql(
        X.STAGED,
        """
        SELECT DISTINCT source, 2 + CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) % 3 AS columns,
               CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) % 3 = 1 AS ok FROM staged WHERE source IS NOT NULL""".replace("\\\\", "\\"),
    ),
)
def header_check(spark, sf_dir):
    """Files of three columns are expected; a third of the sources' files have one less, a third one more."""
    path = work_dir(spark, "header-check")
    s = X.staged(spark, sf_dir).filter("source is not null")
    kind = F.regexp_extract("source", r"(\d+)$", 1).cast("long") % 3
    names = ["title", "url", "content", "category"]
    for k in range(3):
        part = s.filter(kind == k).repartition("source").select("source", *names[: k + 2])
        part.write.mode("append").partitionBy("source").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    found = A.validate_headers(spark, path, names[:3])
    return found.select(F.regexp_extract("file", "source=([^/]+)", 1).alias("source"), "columns", "ok")
