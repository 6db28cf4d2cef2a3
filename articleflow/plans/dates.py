"""Queries over link, markup and date expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from articleflow.functions import dates as D
from articleflow.functions import text as T
from articleflow.plans import fixtures as X
from articleflow.plans.incremental import one_line
from articleflow.plans.registry import query


@query(
    "absolute_url",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE pos % 5 WHEN 0 THEN '' WHEN 1 THEN url
          WHEN 2 THEN 'https://' || source || '.org/' || lower(category) || '/' || CAST(pos AS VARCHAR)
          WHEN 3 THEN 'https://' || source || '.org/x' || CAST(pos AS VARCHAR)
          ELSE 'page/' || CAST(pos AS VARCHAR) END AS url FROM staged""",
    ),
)
def absolute_url(spark, sf_dir):
    m, number = F.col("pos") % 5, F.col("pos").cast("string")
    link = (
        F.when(m == 1, F.col("url")).when(m == 2, F.concat(F.lit("//"), F.lower("category"), F.lit("/"), number))
        .when(m == 3, F.concat(F.lit("x"), number)).when(m == 4, F.concat(F.lit("page/"), number))
    )
    base = F.when(m != 4, F.concat(F.lit("https://"), "source", F.lit(".org//")))
    return X.staged(spark, sf_dir).select("pos", T.absolute_url(link, base).alias("url"))


@query(
    "content_type",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE pos % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'pdf' ELSE 'html' END AS content_type
        FROM staged""",
    ),
)
def content_type(spark, sf_dir):
    m = F.col("pos") % 4
    link = (
        F.when(m == 0, F.lit("")).when(m == 1, F.concat("url", F.lit(".PDF")))
        .when(m == 2, F.concat("url", F.lit(".pdf#page"))).otherwise(F.col("url"))
    )
    return X.staged(spark, sf_dir).select("pos", T.content_type(link).alias("content_type"))


UNSCRIPTED = (
    r"regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', ' ', 'g'), "
    r"'(?s)<!--.*?-->|<[!/?a-zA-Z][^>]*>', ' ', 'g')"
)
PLAIN = (
    "replace(replace(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), "
    "'&nbsp;', chr(160)), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
)


@query(
    "html_text",
    f"SELECT page_id, {one_line(PLAIN)} AS text FROM (SELECT page_id, {UNSCRIPTED} AS x FROM pages) p",
)
def html_text(spark, sf_dir):
    return X.table(spark, sf_dir, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))




@query(
    "feed_date",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE pos % 8 WHEN 7 THEN ''
          WHEN 2 THEN strftime(published_on, '%Y-%m-%d') || ' 00:00:00'
          WHEN 5 THEN strftime(published_on, '%Y-%m-%d') || ' 00:00:00'
          ELSE strftime(published_on, '%Y-%m-%d') || ' 10:20:0' || CAST(pos % 10 AS VARCHAR) END AS published_at
        FROM staged""",
    ),
)
def feed_date(spark, sf_dir):
    """The same instant written the ways feeds write it."""
    d, m = F.col("published_on"), F.col("pos") % 8
    time = F.concat(F.lit("10:20:0"), (F.col("pos") % 10).cast("string"))

    def written(pattern: str):
        return F.date_format(d, pattern)

    raw = (
        F.when(m == 0, F.concat(written("EEE, dd MMM yyyy "), time, F.lit(" +0900")))
        .when(m == 1, F.concat(written("yyyy-MM-dd'T'"), time, F.lit("Z")))
        .when(m == 2, written("yyyy-MM-dd"))
        .when(m == 3, F.concat(written("EEEE, d MMMM yyyy "), time, F.lit(" GMT")))
        .when(m == 4, F.concat(written("yyyy-MM-dd "), time, F.lit(".125-05:00")))
        .when(m == 5, written("MMM d, yyyy"))
        .when(m == 6, F.concat(written("MMMM dd yyyy "), time, F.lit(" EST")))
        .otherwise(F.lit("soon"))
    )
    return X.staged(spark, sf_dir).select("pos", D.feed_date(raw).alias("published_at"))


@query(
    "feed_date_forms",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, strftime(published_on, '%Y-%m-%d') || CASE pos % 7 WHEN 0 THEN ' 21:05:00' WHEN 1 THEN ' 00:30:00' WHEN 4 THEN ' 10:00:05'
          WHEN 5 THEN ' 10:00:00' WHEN 6 THEN ' 23:59:59' ELSE ' 00:00:00' END AS published_at FROM staged""",
    ),
)
def feed_date_forms(spark, sf_dir):
    """Rarer forms: AM and PM, years of two digits, the year last, no-break spaces."""
    d, m = F.col("published_on"), F.col("pos") % 7
    raw = (
        F.when(m == 0, F.date_format(d, "EEE, d MMM yyyy' 9:05 PM'")).when(m == 1, F.date_format(d, "d MMM yyyy' 12:30 am'"))
        .when(m == 2, F.date_format(d, "dd MMM yy")).when(m == 3, F.translate(F.date_format(d, "d MMMM yyyy"), " ", "\u00a0"))
        .when(m == 4, F.date_format(d, "EEE MMM d '10:00:05 UTC' yyyy")).when(m == 5, F.date_format(d, "EEE MMM  d '10:00:00' yyyy"))
        .otherwise(F.date_format(d, "EEEE dd-MMM-yyyy' 23:59:59 EST'"))
    )
    return X.staged(spark, sf_dir).select("pos", D.feed_date(raw).alias("published_at"))


@query(
    "text_date_blanks",
    X.with_sql(X.STAGED, "SELECT pos, CASE pos % 5 WHEN 4 THEN '' ELSE strftime(published_on, '%Y-%m-%d') END AS found FROM staged"),
)
def text_date_blanks(spark, sf_dir):
    """Dates with no-break spaces, line breaks and long runs of blanks between their parts."""
    d, m = F.col("published_on"), F.col("pos") % 5
    mention = (
        F.when(m == 0, F.translate(F.date_format(d, "d MMMM yyyy"), " ", "\u00a0")).when(m == 1, F.regexp_replace(F.date_format(d, "d MMMM yyyy"), " ", " \n\t "))
        .when(m == 2, F.regexp_replace(F.date_format(d, "MMMM d, yyyy"), " ", " " * 40)).when(m == 3, F.regexp_replace(F.date_format(d, "d'th of 'MMM., yyyy"), " ", " " * 7))
        .otherwise(F.date_format(d, "d. MMMM 'in the year' yyyy"))
    )
    text = F.concat_ws(" ", "content", F.lit("on"), mention, F.lit("and"), "title")
    return X.staged(spark, sf_dir).select("pos", D.text_date(text).alias("found"))


# A document with a date written into it, in one of several forms.
@query(
    "text_date",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE pos % 8 WHEN 0 THEN strftime(published_on, '%Y-%m-%d') WHEN 1 THEN strftime(published_on, '%Y-%m-%d')
          WHEN 2 THEN strftime(published_on, '%Y-%m-%d') WHEN 3 THEN strftime(published_on, '%Y-%m-%d')
          WHEN 6 THEN '2025-02-03' ELSE '' END AS found FROM staged""",
    ),
)
def text_date(spark, sf_dir):
    d, m = F.col("published_on"), F.col("pos") % 8
    mention = (
        F.when(m == 0, F.date_format(d, "yyyy/MM/dd")).when(m == 1, F.date_format(d, "dd.MM.yyyy"))
        .when(m == 2, F.date_format(d, "MMMM d, yyyy")).when(m == 3, F.date_format(d, "d MMM yyyy"))
        .when(m == 4, F.date_format(d, "yyyy")).when(m == 5, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("9")))
        .when(m == 6, F.lit("03-02-2025, not 1 May 2024")).otherwise(F.lit("2021-03-04"))
    )
    text = F.concat_ws(" ", "content", F.lit("on"), mention, F.lit("and"), "title")
    return X.staged(spark, sf_dir).select("pos", D.text_date(text).alias("found"))


@query(
    "year_signal",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE pos % 5 WHEN 0 THEN '2026-01-01' WHEN 1 THEN '2021-01-01' WHEN 2 THEN '2026-01-01' ELSE '' END AS found
        FROM staged""",
    ),
)
def year_signal(spark, sf_dir):
    m = F.col("pos") % 5
    mention = (
        F.when(m == 0, "x2026y").when(m == 1, "2021, then 2024").when(m == 2, "2020 to 2026")
        .when(m == 3, "a2024").otherwise("2019")
    )
    text = F.concat_ws(" ", "content", mention, "title")
    return X.staged(spark, sf_dir).select("pos", D.year_signal(text, 2026).alias("found"))


SITE_STYLES = [
    "month_day_year", "numeric", "day_month_year", "dotted_month", "before_comma", "after_label",
    "before_bullet", "slash_day_first", "slash_month_first", "relative", "day_month_abbr",
    "ordinal", "trailing_dot", "feed", "none",
]


@query(
    "site_dates",
    X.with_sql(
        X.STAGED,
        f"""
        SELECT pos, list_extract({SITE_STYLES!r}, CAST(pos % 15 + 1 AS INT)) AS style,
          CASE WHEN pos % 15 = 14 OR pos % 31 = 30 THEN NULL ELSE strftime(published_on, '%Y-%m-%d') END AS day
        FROM staged""",
    ),
)
def site_dates(spark, sf_dir):
    """Every site's way to write a date; every 31st cannot be read."""
    d, p = F.col("published_on"), F.col("pos")
    now = F.lit(X.NOW)
    patterns = [
        F.date_format(d, "MMMM d, yyyy"), F.date_format(d, "dd.MM.yyyy"), F.date_format(d, "dd MMMM yyyy"),
        F.date_format(d, "MMM'.' d, yyyy"), F.date_format(d, "d MMMM yyyy', Frankfurt'"),
        F.concat(F.lit("Published Date: "), F.date_format(d, "dd MMM yyyy")),
        F.date_format(d, "dd MMMM yyyy' • News'"), F.date_format(d, "d/M/yyyy"), F.date_format(d, "M/d/yyyy"),
        F.when(p % 2 == 0, F.concat(F.datediff(now, d).cast("string"), F.lit(" 天前"))).otherwise(F.date_format(d, "M-d")),
        F.date_format(d, "dd MMM yyyy"), F.date_format(d, "d'st of 'MMMM yyyy"),
        F.date_format(d, "d MMMM yyyy' .'"), F.date_format(d, "yyyy-MM-dd'T10:00:00Z'"), F.lit("x"),
    ]
    k = (p % 15).cast("int")
    style = F.get(F.array(*[F.lit(s) for s in SITE_STYLES]), k)
    raw = F.when(p % 31 == 30, F.lit("31 soon")).otherwise(F.get(F.array(*patterns), k))
    s = X.staged(spark, sf_dir).select("pos", style.alias("style"), raw.alias("raw"))
    return s.select("pos", "style", D.site_date(F.col("style"), F.col("raw"), now).cast("string").alias("day"))


