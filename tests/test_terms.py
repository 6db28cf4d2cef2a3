"""Tables of terms, and counters taken while writing."""

import re

from pyspark.sql import functions as F
import pytest

from articleflow.functions import verdicts as V
from articleflow.operators import verdict as J
from articleflow.sources import articles as A
from articleflow.sources import tables as T

TERMS = [
    "cbdc", "central bank digital currency", "digital currency", "digital euro", "digital dollar", "e-cny", "digital yuan", "digital pound",
    "digital rupee", "digital ruble", "digital real", "digital won", "tokenized deposit", "rln", "regulated liability network", "wholesale cbdc",
    "retail cbdc", "stablecoin", "crypto asset", "ledger technology", "dlt", "blockchain",
]


def articles(spark):
    texts = [f"On {t} and more" for t in TERMS] + ["A wholesale CBDC, or central bank digital currency", "none of them", "", None, "retail cbdc " * 300]
    return spark.createDataFrame([(i, t, "x", None) for i, t in enumerate(texts)], "pos long, title string, abstract string, content string")


def test_a_table_of_terms_equals_the_list(spark):
    df = articles(spark)
    terms = spark.createDataFrame([(t,) for t in [*TERMS, "", " - ", None, "Digital  Euro"]], "term string")
    got = {r.pos: r.matched for r in J.keyword_table(df, terms, "pos", ["title", "abstract", "content"]).collect()}
    listed = df.select("pos", V.matched_terms(F.col("title"), F.col("abstract"), F.col("content"), TERMS).alias("n"))
    assert got == {r.pos: r.n for r in listed.collect() if r.n}
    assert J.keyword_table(df, terms.limit(0), "pos", ["title"]).count() == 0 and J.keyword_table(df.limit(0), terms, "pos", ["title"]).count() == 0


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_many_terms_against_a_plain_search(spark, threshold):
    words = [f"w{i}" for i in range(60)]
    terms = [f"{a} {b}" for a in words for b in words] + [f"{a} {b}, {a}" for a in words for b in words[:5]] + words[:3]
    texts = [" ".join(words[(i * k) % 60] for k in range(1, 30)) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, t string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {r.pos: r.matched for r in J.keyword_table(df, spark.createDataFrame([(t,) for t in terms], "term string"), "pos", ["t"]).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    runs = {" ".join(re.findall(r"\w+", t)) for t in terms}
    want = {i: len({" ".join(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)} & runs) for i, w in ((i, t.split()) for i, t in enumerate(texts))}
    assert got == {i: n for i, n in want.items() if n}


def test_counting_reads_nothing_twice(spark, tmp_path):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    lines = spark.createDataFrame([(1, '"a","b"'), (2, '"a"'), (3, '"a","b","c"'), (4, '"x ""y""","p\nq"'), (5, '"",""')], "pos long, line string")
    records = A.parse_lines(lines.mapInArrow(count, lines.schema), "line", ["title", "url"])
    bad = F.col(A.BAD).isNotNull()
    path = str(tmp_path / "batch")
    got = T.write_counted(records, lambda df: T.publish_batch(df.filter(~bad), path, "d"), rows=F.count(F.lit(1)), malformed=F.count(F.when(bad, 1)), first=F.min(F.when(bad, F.col("pos"))))
    assert got == {"rows": 5, "malformed": 2, "first": 2} and passed.value == 5
    stored = {(r.title, r.url) for r in T.read_batches(spark, path).collect()}
    assert stored == {("a", "b"), ('x "y"', "p\nq"), ("", "")}
    none = T.write_counted(records.limit(0), lambda df: T.publish_batch(df, path, "d"), rows=F.count(F.lit(1)))
    assert none == {"rows": 0} and T.read_batches(spark, path).count() == 0


def shuffled_rows(plan):
    """Rows that the shuffles of an executed plan wrote."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled_rows(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return shuffled_rows(plan.plan())
    own = plan.metrics().get("shuffleRecordsWritten")
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    return (own.get().value() if own.isDefined() else 0) + sum(map(shuffled_rows, children))


def test_runs_in_no_term_are_dropped_before_the_shuffle(spark):
    words = [f"w{i}" for i in range(1000)]
    df = spark.createDataFrame([(i, " ".join(words[i:] + words[:i])) for i in range(50)], "pos long, t string")
    terms = spark.createDataFrame([(f"{words[i]} {words[i + 1]}",) for i in range(100, 130)] + [("w5 - w7",)], "term string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = J.keyword_table(df, terms, "pos", ["t"])
        assert {r.pos: r.matched for r in found.collect()} == dict.fromkeys(range(50), 30)
        # The runs in terms, twice (to count and to join), the terms and the counts; not all 49,950 runs.
        assert shuffled_rows(found._jdf.queryExecution().executedPlan()) < 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_filter_keeps_every_key(spark):
    few = spark.range(0, 30_000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(30_000).select("id", F.concat(F.lit("k"), "id").alias("key")).union(spark.createDataFrame([(-1, None)], "id long, key string"))
    got = [r.id for r in J.may_be_in(rows, few, "key", 10_000).collect()]
    assert len(got) == len(set(got)) and {i for i in range(0, 30_000, 3)} <= set(got) and len(got) < 12_000
    assert J.may_be_in(rows, few, "key", 1).filter("id % 3 = 0").count() == 10_000
