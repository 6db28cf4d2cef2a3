from datetime import date

from pyspark.sql import functions as F

from articleflow.operators import blocks as B
from articleflow.operators.collect import accepted_items, as_articles, with_page_date
from articleflow.operators.filters import apply_undated_policy
from articleflow.operators.ordered import fill_down, take_while
from articleflow.session import settle
from articleflow.sources import dom, pages
from articleflow.sources.rules import JOB_ORDER, SITE_RULES

NOW = date(2024, 1, 31)


def contents(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id bigint, source string, url string, html string")
    done = B.page_content(pages.extract_blocks(pages.with_rules(df)))
    return {r["page_id"]: r["content"] for r in done.select("page_id", "content").collect()}


def items(spark, source, html):
    df = spark.createDataFrame([(1, source, html)], "page_id bigint, source string, html string")
    found = settle(pages.extract_items(pages.with_rules(df)), "items")
    return settle(pages.resolve_items(found, F.lit(NOW)), "resolved").orderBy("pos")


def test_every_job_has_a_rule():
    assert sorted(r["source"] for r in SITE_RULES) == sorted(JOB_ORDER)


def test_any_number_of_rules_and_sources_without_one(spark):
    many = [{**SITE_RULES[0], "source": f"s{i}", "entity": "E"} for i in range(10_001)]
    got = pages.with_rules(spark.createDataFrame([("s10000",), ("other",), (None,)], "source string"), many)
    assert {r.source: r.entity for r in got.collect()} == {"s10000": "E", "other": "generic", None: "generic"}


def test_nothing_is_capped_unless_a_rule_says_so(spark):
    rule = {"source": "x", "entity": "e", "category": "c"}
    page = pages.with_rules(spark.range(500).select(F.lit("x").alias("source"), F.col("id").alias("pos")), [rule])
    items = page.select(
        "*", F.lit("t").alias("title"), F.concat(F.lit("http://x/"), "pos").alias("link"), F.lit("d").alias("date_raw"),
        F.lit(NOW).cast("date").alias("published_on"), F.lit(99).alias("page_no"),
    )
    assert accepted_items(items, NOW).count() == 500
    assert accepted_items(items.withColumn("cap", F.lit(7)), NOW).count() == 7


def test_a_sorted_site_keeps_the_fresh_entry_of_a_link(spark):
    rows = [("x", 0, "http://a", "old", date(2023, 1, 1)), ("x", 1, "http://a", "new", NOW), ("x", 2, "http://b", "", None)]
    for sort, left in ((True, ["http://a"]), (False, [])):
        rule = {"source": "x", "entity": "e", "category": "c", "sort_by_date": sort, "needs_date": True, "on_unparsed": "today"}
        df = spark.createDataFrame(rows, "source string, pos long, link string, date_raw string, published_on date").withColumn("title", F.lit("t"))
        assert [r.link for r in accepted_items(pages.with_rules(df, [rule]), NOW).collect()] == left


def test_stray_quotes_and_unmatched_tags():
    root = dom.parse("<p title='it's'>one</p><p>two</p>")
    assert [n.text() for n in dom.select(root, "p")] == ["one", "two"]
    root = dom.parse('<p data-x=">one</p><p>two</p>')
    assert [n.text() for n in dom.select(root, "p")] == ["one", "two"]
    root = dom.parse('<a title="x > y" href=u>z</a><p a"b>q')
    assert dom.first(root, "a").attrs == {"title": "x > y", "href": "u"} and dom.first(root, "p").text() == "q"
    import time

    def spent(n):
        start = time.perf_counter()
        dom.parse("<div>" * n + "</b>" * n + "<a x='" * n)
        return time.perf_counter() - start

    spent(2000)
    assert spent(40_000) < 30 * max(spent(4000), 0.01)


def test_open_paragraphs_end_where_the_next_starts():
    root = dom.parse("<article><p><b>one<br><p>two &amp; three<ul><li>a<li>b</ul></p>tail</article>")
    assert [n.text() for n in dom.select(root, "p")] == ["one", "two & three"]
    assert [n.text() for n in dom.select(root, "li")] == ["a", "b"]


def test_raw_text_and_comments():
    root = dom.parse("<title>a <b></title><script>'<p>x</p>'</script><!-- <p>no</p> --><p title='a>b' class=\"c d\">y</p><p>z")
    assert [(n.text(), n.attrs.get("title")) for n in dom.select(root, "p")] == [("y", "a>b"), ("z", None)]
    assert root.text() == "a <b> y z"
    assert dom.first(root, "p.d.c").text() == "y" and dom.first(root, "p.e") is None


def test_selectors():
    root = dom.parse("<div id=main><ul class='l x'><li><a href=/news/1>1</a><span>s</span><span>t</span></ul></div><div><a>2</a></div>")
    pick = lambda s: [n.text() for n in dom.select(root, s)]
    assert pick("div#main a,div > a") == ["1", "2"] and pick("div > a") == ["2"]
    assert pick("a[href*=NEWS]") == ["1"] and pick("a[href]") == ["1"] and pick("span:first-child") == []
    assert pick("li > :not(.x)") == ["1", "s", "t"] and pick("ul:not(.x)") == []


def test_feed_page(spark):
    html = (
        "<body><nav><p>navigation</p></nav><main><h1>Headline</h1><div class='social-share'><p>share this page</p></div>"
        "<p>short</p><p>long enough</p><table><tr><td><p>in a table</p></table><blockquote>quoted text</blockquote></main>"
        "<p>outside main</p></body>"
    )
    by_class = "<body><p>outside it</p><div class='Press-Release'><p>inside it</p></div></body>"
    got = contents(spark, ("rss", "u", html), ("rss", "u", by_class), ("rss", "u", "<body><p>only body</p></body>"), ("rss", "u", None))
    assert got == {0: "Headline\n\nlong enough\n\nquoted text", 1: "inside it", 2: "only body", 3: ""}


def test_sufficient_container(spark):
    long = "x" * 101
    html = f"<div class='article-body'><p>a</p></div><article><p>{long}</p></article><main><p>b</p></main>"
    small = "<div class='article-body'><p>a</p></div><article></article><main><p>b</p></main>"
    none = "<article>no paragraphs</article><div><p>c</p><p>d</p></div>"
    assert contents(spark, ("imf", "u", html), ("imf", "u", small), ("imf", "u", none)) == {0: long, 1: "b", 2: "c d"}


def test_longest_container(spark):
    section = "<div class='section'><h2>A heading of twenty chars</h2><p>short</p><li>li</li><nav><p>{}</p></nav></div>"
    html = f"<main>{section.format('n' * 90)}<div class='section'><p>{'y' * 30}</p></div></main>"
    body = "<body><p>" + "z" * 25 + "</p><p>short</p></body>"
    got = contents(spark, ("ecb", "u", html), ("ecb", "u", body))
    assert got[0] == f"A heading of twenty chars\n\nli\n\n{'y' * 30}"
    assert got[1] == "z" * 25


def test_trim_without_a_container(spark):
    six = "".join(f"<p>p{i}</p>" for i in range(6))
    five = "".join(f"<p>p{i}</p>" for i in range(5))
    box = "<div class='content'><p>in</p><div class='paragraph'>para</div></div>" + six
    got = contents(spark, ("cbr", "u", six), ("cbr", "u", five), ("cbr", "u", box))
    assert got == {0: "p2", 1: "p0 p1 p2 p3 p4", 2: "in para"}


def test_remaining_sites(spark):
    got = contents(
        spark,
        ("boj", "https://x/a.PDF", "<body>x</body>"),
        ("boj", "u", "<article><p>short</p><p>long enough</p></article>"),
        ("boj", "u", "<body>plain body text</body>"),
        ("mas", "u", "<div class='mas-rte-content'><p>one</p><p> *** </p><ul><li>two</ul><p>End of  document</p></div>"),
        ("mas", "u", "<p>no container</p>"),
        ("sama", "u", "<div class='pagecontent'><div class='ms-rtestate-field'><div>a<p>b</p></div></div></div>"),
        ("bcra", "u", "<div class='clearfix pagina-interior'><p class='post-pagina-interior'>b <b>c</b></p><h2>A <i>t</i></h2><h2>no</h2></div>"),
        ("weiyang", "u", "<div class='wyt-single-output'><p>本文共12字</p><p>甲<b>乙</b></p><div uk-grid><p>x</p></div><h2>丙</h2></div>"),
        ("bahamas", "u", "<div class='right_content'><p>p</p><h1 class='cms_detail_h2'>T</h1></div>"),
        ("tcmb", "u", "<div class='type-prg tcmb-content'><h2>h</h2><p>p</p></div><p>out</p>"),
        ("tcmb", "u", "<p>only</p>"),
    )
    assert got == {
        0: "[PDF] https://x/a.PDF", 1: "long enough", 2: "plain body text", 3: "one\n\ntwo", 4: "",
        5: "a b\n\nb", 6: "A t\n\nb c".replace("A t", "At"), 7: "甲乙\n丙", 8: "T\n\np", 9: "h p", 10: "only",
    }


def test_listing_links_and_dates(spark):
    html = (
        "<article class='mas-search-card'><a class='mas-link--no-underline' href='/news/1'><span class='mas-link__text'> One </span></a>"
        "<div class='ts:xs'>Published Date: 30 January 2024</div><div class='mas-search-card__body'><p>abs</p></div></article>"
        "<article class='mas-search-card'><a class='mas-link--no-underline' href='https://o/2'><span class='mas-link__text'>Two</span></a></article>"
        "<article class='mas-search-card'><a class='mas-link--no-underline' href='/news/3'><span class='mas-link__text'>Three</span></a>"
        "<div class='ts:xs'>1 Jan 2024</div></article>"
    )
    found = items(spark, "mas", html)
    dated = apply_undated_policy(found, NOW, days=60)
    kept = take_while(dated, ["source"], "pos", F.col("published_on") >= F.lit(date(2024, 1, 30)))
    got = [(r["title"], r["link"], str(r["published_on"]), r["abstract"]) for r in kept.orderBy("pos").collect()]
    assert got == [("One", "https://www.mas.gov.sg/news/1", "2024-01-30", "abs"), ("Two", "https://o/2", "2024-01-31", "")]


def test_listing_headers_fill_down(spark):
    html = (
        "<dl><dt>31 January 2024<dd><div class='title'><a href='/a'>A</a></div><dd><div class='title'><a href='/b'>B</a></div>"
        "<dt>soon<dd><div class='title'><a href='/c'>C</a></div><dt>30 January 2024, x<dd><div class='title'><a href='/d'>D</a></div></dl>"
    )
    found = items(spark, "ecb", html)
    filled = fill_down(found, ["source"], "pos", F.col("link") == "", F.col("published_on"), "day")
    got = [(r["link"], str(r["day"])) for r in filled.filter("link <> '' and day is not null").orderBy("pos").collect()]
    base = "https://www.ecb.europa.eu"
    assert got == [(f"{base}/a", "2024-01-31"), (f"{base}/b", "2024-01-31"), (f"{base}/d", "2024-01-30")]


def test_other_listings(spark):
    bahamas = "<div class='news_box'><span class='dd'>05</span><span class='yy'>Jan 2024</span><a class='title_div' href='/n'>N</a><div class='info_cell'><p class='category_div'>c</p><p>abs</p></div></div>"
    row = items(spark, "bahamas", bahamas).first()
    assert (row["link"], str(row["published_on"]), row["abstract"]) == ("https://www.centralbankbahamas.com/n", "2024-01-05", "abs")
    bcra = "<tbody><tr><td><span class='fecha-tabla'>1/5/2024</span><a href='n.asp'>N</a></tr></tbody>"
    row = items(spark, "bcra", bcra).first()
    assert (row["link"], str(row["published_on"])) == ("https://www2.bcra.gob.ar/Noticias/n.asp", "2024-01-05")
    cbr = "<div class='news'><div class='news_date'>05 January 2024</div><div class='news_category'>Press</div><a class='news_title' href='/e'>E</a></div>"
    row = items(spark, "cbr", cbr).first()
    assert (row["category"], row["site_category"], str(row["published_on"])) == ("Press", "news", "2024-01-05")


def test_block_helpers(spark):
    df = spark.createDataFrame(
        [(1, [(0, 0, "p", "abc"), (0, 1, "li", "x"), (1, 2, "p", "abcd"), (1, 3, "p", "")])],
        "page_id int, blocks array<struct<container:int,pos:int,tag:string,text:string>>",
    )
    b = F.col("blocks")
    row = df.select(
        B.join_blocks(B.keep_blocks(b, 3, free_tags=("li",)), "|").alias("free"),
        B.join_blocks(B.keep_blocks(b, 1, "^abc$"), "|").alias("drop"),
        B.longest_container(B.container_texts(b, "")).alias("longest"),
        B.sufficient_container(B.container_texts(b, ""), F.lit("page"), enough=9).alias("last"),
    ).first()
    assert tuple(row) == ("abc|x|abcd", "x|abcd", "abcx", "abcd")
    assert B.block_rows(df, "page_id").count() == 4


def test_items_become_articles(spark):
    html = "<div class='block-collection-box'><a class='collection-title' href='/x'>T</a><div class='collection-tag'>31/01/2024</div></div>"
    found = items(spark, "tcmb", html).withColumn("content", F.lit(" c" * 200))
    row = as_articles(accepted_items(found, NOW), F.lit("2024-01-31 08:00:00")).first()
    assert (row["url"], row["category"], row["published_at"]) == ("https://www.tcmb.gov.tr/x", "press_releases", "2024-01-31")
    paged = found.withColumn("page_no", F.col("page_id") + 49)
    assert accepted_items(paged, NOW).count() == 1
    late = paged.withColumn("page_no", F.lit(51))
    assert accepted_items(late, NOW).count() == 1 and accepted_items(late.withColumn("page_cap", F.lit(50)), NOW).count() == 0
    assert row["abstract"] == "c " * 149 + "c" and row["content_type"] == "html" and row["entity"] == "土耳其"


def test_known_links_end_a_listing(spark):
    card = "<atomic-result><a href='https://x/news/articles/{0}'>t{0}</a><atomic-text value='January 31, 2024'></atomic-text></atomic-result>"
    found = items(spark, "imf", "".join(card.format(i) for i in range(40)))
    history = spark.createDataFrame([(f"https://x/news/articles/{i}",) for i in range(2, 33)], "url string")
    kept = accepted_items(found, NOW, history=history).orderBy("pos")
    assert [r["title"] for r in kept.collect()] == ["t0", "t1"]
    gap = history.filter("url <> 'https://x/news/articles/20'")
    assert accepted_items(found, NOW, history=gap).count() == 10


def test_date_shown_on_the_page(spark):
    page = "<div class='uk-margin-remove uk-text-small'><span>{}</span></div><div class='wyt-single-output'><p>text</p></div>"
    df = spark.createDataFrame(
        [(1, "weiyang", "u", page.format("2024-01-30")), (2, "weiyang", "u", page.format("?")), (3, "mas", "u", "<p>x</p>")],
        "page_id bigint, source string, url string, html string",
    )
    read = B.page_content(pages.extract_blocks(pages.with_rules(df)))
    dated = with_page_date(read.withColumn("published_on", F.lit(date(2024, 1, 2))), NOW)
    got = [(r["page_id"], str(r["published_on"]), r["content"]) for r in dated.orderBy("page_id").collect()]
    assert got == [(1, "2024-01-30", "text"), (2, "2024-01-31", "text"), (3, "2024-01-02", "")]
