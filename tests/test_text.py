from pyspark.sql import functions as F
import pytest

from articleflow.functions import text as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""), ("", ""), ("  a \t b\r\n c  ", "a b c"), ("a​‌b", "a b"), ("a b ", "a b"),
        ("　x  y\u0085", "x y"), ("a\x1cb\x1fc", "a b c"), ("été  là", "été là"), ("​", ""),
    ],
)
def test_clean_one_line(spark, raw, want):
    assert one(spark, T.clean_one_line(F.col("v")), v=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""), ("a\r\nb\rc", "a\nb\nc"), ("a\n \t\n\n\nb", "a\n\nb"), ("\n\n a \n", "a"), ("a\nb", "a\nb"),
        ("a​​b  c", "a b  c"), ("　a\n \nb ", "a\n\nb"), ("a  b", "a b"),
    ],
)
def test_clean_multi_line(spark, raw, want):
    assert one(spark, T.clean_multi_line(F.col("v")), v=raw) == want


def test_uid_keeps_the_source_in_the_hash(spark):
    import hashlib

    for source, link in [("rss", "https://x/y"), ("imf", "https://x/y"), ("rss", "")]:
        want = hashlib.sha256(f"{source}|{link}".encode()).hexdigest()
        assert one(spark, T.make_uid(F.col("s"), F.col("u")), s=source, u=link) == want


@pytest.mark.parametrize(
    "link, base, want",
    [
        (None, "https://b", ""), ("", "https://b", ""), ("http://a", "https://b", "http://a"),
        ("//x/y", "https://b//", "https://b/x/y"), ("x", "https://b", "https://b/x"), ("x", "", "x"), ("x", None, "x"),
    ],
)
def test_absolute_url(spark, link, base, want):
    assert one(spark, T.absolute_url(F.col("a"), F.col("b")), a=link, b=base) == want


@pytest.mark.parametrize(
    "link, base, directory, want",
    [
        ("//h/x", "https://b", "", "https://h/x"), ("/x", "https://b", "", "https://b/x"), ("", "https://b", "", ""),
        ("n.asp", "https://b", "/Noticias/", "https://b/Noticias/n.asp"), ("https://c", "https://b", "", "https://c"),
    ],
)
def test_prefixed_url(spark, link, base, directory, want):
    got = one(spark, T.prefixed_url(F.col("a"), F.col("b"), F.col("c")), a=link, b=base, c=directory)
    assert got == want


@pytest.mark.parametrize("link, want", [("", "unknown"), (None, "unknown"), ("a.PDF", "pdf"), ("a.pdf?x", "html")])
def test_content_type(spark, link, want):
    assert one(spark, T.content_type(F.col("v")), v=link) == want


@pytest.mark.parametrize("n, want", [(49, "x" * 49), (50, "x" * 47 + "..."), (0, "")])
def test_title_short(spark, n, want):
    assert one(spark, T.title_short(F.col("v")), v="x" * n) == want


def test_numerals(spark):
    want = {
        -1: "-1", 0: "0", 1: "一", 9: "九", 10: "十", 11: "十一", 20: "二十", 21: "二十一", 99: "九十九", 100: "100",
    }
    df = spark.createDataFrame([(k,) for k in want], "n bigint").select("n", T.cn_numeral(F.col("n")).alias("x"))
    assert {r["n"]: r["x"] for r in df.collect()} == want


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""), ("<p>a<b>b</b>  c</p>", "a b c"), ("x &amp; y &lt;z&gt;", "x & y <z>"), ("&#8364;&#x20AC;", "€€"),
        ("a<!-- <b>no</b> -->b", "a b"), ("<script>var a='<p>';</script>x", "x"), ("AT&T &nope; &", "AT&T &nope; &"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("&amp;lt;", "&lt;"), ("caf&eacute;&nbsp;!", "café !"),
    ],
)
def test_html_text(spark, html, want):
    assert one(spark, T.html_text(F.col("v")), v=html) == want


def test_references_and_tags_like_the_page_walker(spark):
    from html import unescape

    from articleflow.functions.text import html_text

    texts = ["&comma;&lsquor;x&#146;y&#x93;", "&CounterClockwiseContourIntegral;", "&nosuchname; &amp;lt;", "a<p title='x > y'>b</p>c", "1 < 2 &#128;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(html_text(F.col("t"))).collect()]
    assert got == [unescape(texts[0]), unescape(texts[1]), unescape(texts[2]), "a b c", "1 < 2 \u20ac"]
