from datetime import date

from pyspark.sql import functions as F

from articleflow.functions import dates as D


def run(spark, column, rows, schema="v string"):
    return [r["x"] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column.alias("x")).collect()]


FEED = {
    "Wed, 31 Jan 2024 10:00:05 +0900": "2024-01-31 10:00:05", "31 Jan 2024 10:00 GMT": "2024-01-31 10:00:00",
    "2024-01-31T10:00:05Z": "2024-01-31 10:00:05", "2024-01-31T10:00:05.123+02:00": "2024-01-31 10:00:05",
    "2024-01-31": "2024-01-31 00:00:00", "January 31, 2024": "2024-01-31 00:00:00", "20240131": "2024-01-31 00:00:00",
    "Sept 5, 2024": "2024-09-05 00:00:00", "Thu, 1 Feb 2024 9:05 PM": "2024-02-01 21:05:00", "1 Feb 2024 12:30 am": "2024-02-01 00:30:00",
    "01 Feb 24 10:00:00 GMT": "2024-02-01 10:00:00", "1 Feb 99": "1999-02-01 00:00:00", "1 Sept 2024": "2024-09-01 00:00:00", "2024-02-01T10:00:00+01": "2024-02-01 10:00:00",
    "Thu Feb  1 10:00:00 UTC 2024": "2024-02-01 10:00:00", "Thu Feb 1 10:00:00 2024": "2024-02-01 10:00:00", "10\u00a0May\u00a02024": "2024-05-10 00:00:00", "2024-02-30": "", "soon": "", "": "", "01/31/2024": "2024-01-31 00:00:00",
    "31/01/2024": "2024-01-31 00:00:00", "Tuesday 05-Mar-2024 23:59:59 EST": "2024-03-05 23:59:59",
}


def test_feed_date(spark):
    got = run(spark, D.feed_date(F.col("v")), [(k,) for k in FEED])
    assert dict(zip(FEED, got)) == FEED
    assert run(spark, D.feed_date(F.col("v")), [(None,)]) == [""]


def test_feed_timestamp_can_apply_the_offset(spark):
    got = run(
        spark, D.feed_timestamp(F.col("v"), to_utc=True).cast("string"),
        [("2024-01-31T01:00:00+02:00",), ("31 Jan 2024 23:30:00 -0100",), ("2024-01-31",)],
    )
    assert got == ["2024-01-30 23:00:00", "2024-02-01 00:30:00", "2024-01-31 00:00:00"]


TEXT = {
    "on 2024-03-05.": "2024-03-05", "2024/03/05": "2024-03-05", "a 05.03.2024 b": "2024-03-05",
    "01-02-2023 then 2024-05-06": "2024-05-06", "x2024-03-05": "", "2024-03-051": "", "2021-03-05": "",
    "May 2024": "", "5 March 2024": "2024-03-05", "the 5th of March 2024": "2024-03-05",
    "Mar. 5, 2024 and 6 Apr 2025": "2025-04-06", "31 February 2024": "", "2024": "", "": "",
    "year 2023, 2024-13-01, 2024-12-01": "2024-12-01", "年2024-03-05": "", "2022 5 May 2023": "2023-05-05",
    "2024-01-012025-02-03": "", "5      March\u00a0\u00a0 \n  2024": "2024-03-05", "x" * 50 + " 7 May 2024": "2024-05-07", "12 May 20245": "",
}


def test_text_date(spark):
    got = run(spark, D.text_date(F.col("v")), [(k,) for k in TEXT])
    assert dict(zip(TEXT, got)) == TEXT


def test_text_date_in_long_texts_equals_short_ones(spark):
    fill = "lorem 2023 ipsum " * 500
    keys = [k for k in TEXT if k]
    got = run(spark, D.text_date(F.col("v")), [(f"{fill}{k} {fill}",) for k in keys])
    assert dict(zip(keys, got)) == {k: TEXT[k] for k in keys}


def test_year_signal(spark):
    want = {
        "x2026y and 2021": "2026-01-01", "2023 and 2021": "2023-01-01", "a2023": "", "2019": "", "": "", "12020": "",
    }
    assert dict(zip(want, run(spark, D.year_signal(F.col("v"), 2026), [(k,) for k in want]))) == want


def test_entry_date_cascade(spark):
    rows = [("bad", "on 2024-03-05"), ("2024-01-01", "on 2024-03-05"), ("", "in 2025"), ("", "nothing")]
    got = run(spark, D.entry_date(F.col("r"), F.col("t"), 2026), rows, "r string, t string")
    assert got == ["2024-03-05 00:00:00", "2024-01-01 00:00:00", "2025-01-01 00:00:00", ""]


SITE = [
    ("month_day_year", "January 5, 2024", "2024-01-05"), ("month_day_year", "Jan 5, 2024", None),
    ("numeric", "05/01/2024", "2024-01-05"), ("numeric", "2024-01-05", "2024-01-05"), ("numeric", "05-01-2024", "2024-01-05"),
    ("numeric", "13/13/2024", None), ("day_month_year", "05 January 2024", "2024-01-05"),
    ("day_month_year", "5 Jan 2024", None), ("dotted_month", "Jan. 5, 2024", "2024-01-05"),
    ("dotted_month", "+ Jan. 5, 2024", None), ("dotted_month", "Sept. 5, 2024", None),
    ("before_comma", "5 Jan 2024, Frankfurt", "2024-01-05"), ("after_label", "Published Date: 05 January 2024", "2024-01-05"),
    ("after_label", "05 Jan 2024", "2024-01-05"), ("before_bullet", "5 January 2024 • News", "2024-01-05"),
    ("slash_day_first", "5/1/2024 x", "2024-01-05"), ("slash_day_first", "1/13/2024", None),
    ("slash_month_first", "1/5/2024", "2024-01-05"), ("slash_month_first", "13/1/2024", None),
    ("relative", "3 天前", "2024-01-28"), ("relative", "发布 2023.12.5", "2023-12-05"), ("relative", "12-25", "2024-12-25"),
    ("relative", "刚刚", None), ("day_month_abbr", "05 Jan 2024", "2024-01-05"), ("day_month_abbr", "05 January 2024", None),
    ("ordinal", "1st of March 2024", "2024-03-01"), ("ordinal", "Published on the 2 April 2024", "2024-04-02"),
    ("trailing_dot", "5 January 2024.", "2024-01-05"), ("trailing_dot", "5 January", None),
    ("trailing_dot", "5 január 2024.", None), ("feed", "2024-01-05T00:00:00Z", "2024-01-05"), ("other", "2024-01-05", None),
    ("numeric", "", None), ("numeric", None, None),
]


def test_site_dates(spark):
    df = spark.createDataFrame(SITE, "style string, raw string, want string")
    got = df.withColumn("got", D.site_date(F.col("style"), F.col("raw"), F.lit(date(2024, 1, 31))).cast("string"))
    assert [tuple(r) for r in got.filter("not (got <=> want)").collect()] == []
