"""Listings made of lines, answers kept between runs, numbers by ranges, and header checks."""

import json

from pyspark.sql import functions as F
import pytest

from articleflow.functions import verdicts as V
from articleflow.operators import ordered as O
from articleflow.operators import scoring as S
from articleflow.operators.collect import accepted_items, as_articles, entry_articles
from articleflow.sources import articles as A
from articleflow.sources import dom, pages

LISTING = """<html><head><title>Jan. 1, 2020</title><script>Feb. 1, 2024</script></head><body><h1>News</h1>
<table><tr><td>Jan. 31, 2024</td><td></td></tr><tr><td><p>Monetary <b>policy</b> section</p>
<a href="/en/a.pdf">Outlook
 for prices [PDF 90KB]</a> (new)</td></tr>
<tr><td>Foo. 45, 2024</td></tr><tr><td><a href="/en/lost.htm">Lost paper [PDF 1KB]</a></td></tr>
<tr><td>Jan. 30, 2024</td></tr><tr><td>short<br><a href="/en/b.htm">A plain title</a></td></tr>
<tr><td>Jan. 3, 2024</td></tr><tr><td><a href="http://other/c.htm">Old one [Notice]</a></td></tr></table></body></html>"""


def test_lines_of_a_page_and_what_covers_them():
    lines = dom.text_lines(dom.parse(LISTING))
    assert lines[:4] == [("News", ""), ("Jan. 31, 2024", ""), ("Monetary policy section", ""), ("Outlook for prices [PDF 90KB] (new)", "/en/a.pdf")]
    assert ("A plain title", "/en/b.htm") in lines and ("short", "") in lines
    assert dom.text_lines(dom.parse("")) == [] and dom.text_lines(dom.parse("a<p>b<a href=x>c</a>d<p><a>e</a>")) == [("a", ""), ("bcd", "x"), ("e", "")]
    assert dom.text_lines(dom.parse("<tr><td>a</td><td>b&amp;c</td></tr>x")) == [("a b&c", ""), ("x", "")]


def test_a_listing_of_lines_gives_items(spark):
    df = spark.createDataFrame([(1, "boj", LISTING), (2, "boj", None), (3, "boj", "no dates"), (4, "ecb", LISTING)], "page_no long, source string, html string")
    items = pages.resolve_items(pages.line_items(pages.with_rules(df), ["page_no"]), F.lit("2024-01-31").cast("date"))
    got = [(str(r.published_on), r.title, r.link, r.category) for r in items.orderBy("pos").collect()]
    base = "https://www.boj.or.jp"
    assert got == [
        ("2024-01-31", "Outlook for prices [PDF 90KB] (new)", f"{base}/en/a.pdf", "Monetary policy section"),
        ("None", "Lost paper [PDF 1KB]", f"{base}/en/lost.htm", ""),
        ("2024-01-30", "short", "", "A plain title"),
        ("2024-01-03", "Old one [Notice]", "http://other/c.htm", ""),
    ]
    taken = accepted_items(items, F.lit("2024-01-31").cast("date"), days=2)
    done = as_articles(taken.withColumn("content", F.lit("text")), F.lit("now")).collect()
    assert [(r.title, r.category, r.content_type, r.entity) for r in done] == [("Outlook for prices [PDF 90KB] (new)", "Monetary policy section", "pdf", "日本")]


def test_a_feed_entry_gets_the_text_of_its_page(spark):
    columns = "pos long, uid string, source string, entity string, category string, published_at string, title string, url string, abstract string, content_type string"
    made = [(1, "u1", "http://p/1", "html"), (2, "u2", "http://p/2", "html"), (3, "u3", "", "html"), (4, "u4", "http://p/1", "pdf")]
    entries = spark.createDataFrame([(i, u, "rss", "E", "c", "2024-01-31", "t", url, "a", kind) for i, u, url, kind in made], columns)
    landed = spark.createDataFrame([("http://p/1", "<main><p>The whole text</p><nav>menu entry</nav></main>"), ("http://p/1", None), ("http://p/9", "<p>not asked for</p>")], "url string, html string")
    got = {r.pos: r.content for r in entry_articles(entries, landed, F.lit("now")).collect()}
    assert got == {1: "The whole text", 2: "", 3: "", 4: ""}


def prompts(spark, n, copies=3):
    rows = [(i, f"prompt {i}") for i in range(n) for _ in range(copies)] + [(999, None)]
    return spark.createDataFrame(rows, "id long, prompt string")


def test_equal_prompts_are_scored_once_and_a_second_run_scores_none(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def scorer(texts):
        asked.add(len(texts))
        return [json.dumps({"said": t}) for t in texts]

    path = str(tmp_path / "answers")
    for _ in range(2):
        got = S.score_once(prompts(spark, 20), {"m": ("v1", scorer)}, path, parts=3).collect()
        assert asked.value == 20 and len(got) == 61
        assert all((r.m_raw is None) == (r.id == 999) and (r.id == 999 or json.loads(r.m_raw) == {"said": f"prompt {r.id}"}) for r in got)
    S.score_once(prompts(spark, 25), {"m": ("v1", scorer)}, path).count()
    assert asked.value == 25
    S.score_once(prompts(spark, 5), {"m": ("v2", scorer)}, path).count()
    assert asked.value == 30 and S.stored_answers(spark, path, "v1").count() == 25
    assert S.score_once(prompts(spark, 0).limit(0), {"m": ("v1", scorer)}, path).count() == 0


def test_a_run_that_fails_goes_on_and_failures_are_asked_again(spark, tmp_path, monkeypatch):
    path, asked = str(tmp_path / "answers"), spark.sparkContext.accumulator(0)

    def scorer(texts):
        asked.add(len(texts))
        if any(t == "prompt 3" for t in texts):
            raise ValueError
        return [t.upper() for t in texts]

    real, calls = S.snapshots.publish, []

    def dying(rows, *args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return real(rows, *args)

    monkeypatch.setattr(S.snapshots, "publish", dying)
    with pytest.raises(RuntimeError):
        S.score_once(prompts(spark, 40), {"m": ("v", scorer)}, path, parts=4)
    kept = S.stored_answers(spark, path, "v").count()
    assert 0 < kept < 39
    monkeypatch.setattr(S.snapshots, "publish", real)
    before = asked.value
    got = {r.id: r.m_raw for r in S.score_once(prompts(spark, 40), {"m": ("v", scorer)}, path, parts=4).collect()}
    assert got[3] is None and got[4] == "PROMPT 4" and S.stored_answers(spark, path, "v").count() == 39
    # What the broken run had kept was not asked again (a failing batch is asked again in halves).
    assert asked.value - before < 40 - kept + 30


def test_numbers_by_range_hold_whatever_the_positions(spark):
    rows = [(("a" if i % 3 else None) if i < 900 else "b", (i * 7919) % (1 << 40) * 1_000_003, i) for i in range(1200)] + [("b", None, 5000)]
    df = spark.createDataFrame(rows, "k string, place long, id long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = O.numbered_by_range(df, ["place"], "no", ["k"], ranges=8)
        key = lambda r: (r[1] is not None, r[1] or 0)
        want = {r[2]: n for k in (None, "a", "b") for n, r in enumerate(sorted((r for r in rows if r[0] == k), key=key), 1)}
        assert {r.id: r.no for r in got.collect()} == want
        whole = {r.id: r.no for r in O.numbered_by_range(df, ["place"], "no", ranges=8).collect()}
        assert whole == {r[2]: n for n, r in enumerate(sorted(rows, key=key), 1)}
        # The key that has half of the rows is dealt over several ranges.
        sizes = [r["count"] for r in df.repartitionByRange(8, "k", "place").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.3 * len(rows)
        first = O.first_n_by_range(df, ["k"], ["place"], 4).groupBy("k").count().collect()
        assert {r.k: r["count"] for r in first} == {None: 4, "a": 4, "b": 4}
        assert O.numbered_by_range(df.limit(0), ["place"], "no", ["k"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_headers_are_checked_by_file(spark, tmp_path):
    texts = {"good": '"a","b, c"\n"1","x\ny"\n', "bom": "﻿a,b\n", "short": "a\n1\n", "long": "a,b,c\n1,2\n", "empty": ""}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    got = {r.file.rsplit("/", 1)[1]: (r.columns, r.ok) for r in A.validate_headers(spark, str(tmp_path), ["a", "b"]).collect()}
    assert {k: v for k, v in got.items() if k != "empty.csv"} == {"good.csv": (2, True), "bom.csv": (2, True), "short.csv": (1, False), "long.csv": (3, False)}
    assert got.get("empty.csv", (0, True)) == (0, True)


def test_the_prompt_shows_a_sample_of_any_length(spark):
    df = spark.createDataFrame([("t", "a", "x" * 3000)], "t string, a string, c string")
    sizes = [len(df.select(V.prompt(F.col("t"), F.col("a"), F.col("c"), sample=n)).first()[0]) for n in (10, 1000, 2500)]
    assert sizes[1] - sizes[0] == 990 and sizes[2] - sizes[1] == 1500
