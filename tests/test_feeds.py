from pyspark.sql import functions as F

from articleflow.sources import feeds

RSS = """<?xml version="1.0"?><rss><channel><title>feed</title>
<item><title>A &amp; B</title><link> /a </link><pubDate>Wed, 31 Jan 2024 10:00:00 +0100</pubDate><description>&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;</description></item>
<item><title>No date, on 2024-01-30</title><link>https://x/b</link></item>
<item><title>Nothing</title></item></channel></rss>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/">
<item><title>R</title><link>https://x/r.pdf</link><dc:date>2024-01-29T00:00:00Z</dc:date></item></rdf:RDF>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link rel="self" href="https://x/self"/>
<link rel="alternate" href="https://x/e"/><updated>2024-01-28T01:02:03Z</updated><summary>s</summary></entry></feed>"""


def test_feed_documents(spark):
    docs = spark.createDataFrame([("f1", RSS), ("f2", RDF), ("f3", ATOM), ("f4", "no feed"), ("f5", None)], "feed_url string, xml string")
    registry = spark.createDataFrame(
        [("E1", "kind", "", "f1", "https://b/"), ("E2", "kind", "cat", "f2", ""), ("E3", None, None, "f3", "")], feeds.REGISTRY_COLUMNS
    )
    entries = feeds.feed_entries(docs, "xml")
    assert entries.count() == 5
    rows = feeds.resolve_entries(entries, registry, 2026).orderBy("published_at", ascending=False).collect()
    got = [(r["entity"], r["category"], r["published_at"], r["title"], r["url"], r["abstract"], r["content_type"]) for r in rows]
    assert got == [
        ("E1", "kind", "2024-01-31 10:00:00", "A & B", "https://b/a", "Hi & bye", "html"),
        ("E1", "kind", "2024-01-30 00:00:00", "No date, on 2024-01-30", "https://x/b", "", "html"),
        ("E2", "cat", "2024-01-29 00:00:00", "R", "https://x/r.pdf", "", "pdf"),
        ("E3", "", "2024-01-28 01:02:03", "E", "https://x/e", "s", "html"),
    ]


def test_feed_files_batch_and_stream(spark, tmp_path):
    rss, atom = tmp_path / "rss", tmp_path / "atom"
    rss.mkdir(), atom.mkdir()
    (rss / "a.xml").write_text(RSS, encoding="utf-8")
    (rss / "b.xml").write_text(RDF, encoding="utf-8")
    (atom / "c.xml").write_text(ATOM, encoding="utf-8")
    batch = feeds.read_feed_files(spark, str(rss))
    assert sorted((r["title"], r["date_raw"][:10]) for r in batch.collect()) == [
        ("A & B", "Wed, 31 Ja"), ("No date, on 2024-01-30", ""), ("Nothing", ""), ("R", "2024-01-29"),
    ]
    row = feeds.read_feed_files(spark, str(atom), kind="atom").first()
    assert (row["title"], row["link"], row["feed_file"].endswith("c.xml")) == ("E", "https://x/e", True)
    stream = feeds.read_feed_files(spark, str(rss), stream=True)
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_registry(spark):
    r = feeds.feed_registry(spark)
    assert (r.count(), r.select("feed_url").distinct().count(), r.select("entity").distinct().count()) == (65, 65, 16)
    assert r.filter(F.col("base_url") != "").select("entity").distinct().count() == 2


def test_feed_files_to_history(spark, tmp_path):
    """Feed files as a stream, resolved against the registry, into the history."""
    from datetime import date

    from articleflow.sources import tables
    from articleflow.streaming.ingest import ingest

    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "boj.xml").write_text(RSS, encoding="utf-8")
    entries = feeds.read_feed_files(spark, str(landing), stream=True).withColumn(
        "feed_url", F.lit("https://www.boj.or.jp/en/rss/whatsnew.xml")
    )
    rows = feeds.resolve_entries(entries, feeds.feed_registry(spark), 2026)
    for _ in range(2):
        ingest(
            rows, str(tmp_path / "history"), str(tmp_path / "cp"), "pos", lambda batch_id: date(2024, 1, 31)
        ).awaitTermination()
    got = tables.read_history(spark, str(tmp_path / "history")).orderBy("title").collect()
    assert [(r["entity"], r["title"], r["published_at"], r["load_id"]) for r in got] == [
        ("日本", "A & B", "2024-01-31 10:00:00", 0), ("日本", "No date, on 2024-01-30", "2024-01-30 00:00:00", 0),
    ]
