"""Ordered scans against plain loops, with one key holding most rows and tiny chunks."""

import random

from pyspark.sql import functions as F
import pytest

from articleflow.operators import ordered as O


@pytest.fixture(autouse=True)
def tiny_chunks(monkeypatch):
    monkeypatch.setattr(O, "CHUNK_BITS", 3)


def listing(seed, n=400):
    rng = random.Random(seed)
    out, streak = [], False
    for pos in rng.sample(range(3 * n), n):
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        out.append((key, pos))
    out.sort(key=lambda r: r[1])
    rows = []
    for key, pos in out:
        if rng.random() < 0.05:
            streak = not streak
        rows.append((key, pos, streak or rng.random() < 0.3, rng.random() < 0.01, f"v{rng.randrange(50)}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, pos bigint, seen boolean, old boolean, v string").repartition(3)


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_running(spark, seed):
    rows = listing(seed)
    want = []
    for key, items in groups(rows).items():
        total, best = 0, None
        for _, pos, seen, _, v in items:
            total += int(seen)
            best = max(x for x in (best, v if seen else None) if x is not None) if (best or seen) else None
            want.append((key, pos, total, best))
    df = O.running(
        frame(spark, rows), ["k"], "pos", sums={"n": F.col("seen").cast("int")}, maxes={"m": F.when(F.col("seen"), F.col("v"))}
    )
    assert sorted(got(df, "k", "pos", "n", "m"), key=repr) == sorted(want, key=repr)


def test_exclusive_running(spark):
    df = spark.range(1, 50).select(F.lit("a").alias("k"), F.col("id").alias("pos"))
    out = O.running(df, ["k"], "pos", sums={"n": F.col("pos")}, inclusive=False)
    assert got(out, "pos", "n") == [(p, sum(range(1, p))) for p in range(1, 50)]


@pytest.mark.parametrize("seed", [1, 2])
def test_take_while(spark, seed):
    rows = listing(seed)
    want = []
    for key, items in groups(rows).items():
        for r in items:
            if r[3]:
                break
            want.append((key, r[1]))
    assert got(O.take_while(frame(spark, rows), ["k"], "pos", ~F.col("old")), "k", "pos") == sorted(want)


def test_take_while_stops_at_undated_rows(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, None), ("a", 3, True)], "k string, pos bigint, ok boolean")
    assert got(O.take_while(df, ["k"], "pos", F.col("ok")), "pos") == [(1,)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_seen_streak(spark, seed):
    rows = listing(seed)
    want = []
    for key, items in groups(rows).items():
        run = 0
        for _, pos, seen, old, _ in items:
            if old:
                break
            if seen:
                run += 1
                if run >= 9:
                    break
                continue
            run = 0
            want.append((key, pos))
    df = O.until_seen_streak(frame(spark, rows), ["k"], "pos", F.col("seen"), limit=9, old=F.col("old"))
    assert got(df, "k", "pos") == sorted(want)


def test_first_n(spark):
    rows = listing(5)
    want = [(k, r[1]) for k, items in groups(rows).items() for r in items[:25]]
    assert got(O.first_n(frame(spark, rows), ["k"], "pos", 25), "k", "pos") == sorted(want)


def test_numbering(spark):
    rows = listing(6)
    df = O.numbered(frame(spark, rows).filter("seen"), "pos", "no")
    want = [(r[1], i + 1) for i, r in enumerate(x for x in rows if x[2])]
    assert got(df, "pos", "no") == want


@pytest.mark.parametrize("seed", [1, 2])
def test_fill_down(spark, seed):
    """``seen`` rows are headers; those marked ``v1x`` cannot be read and clear the value."""
    rows = listing(seed)
    want = []
    for key, items in groups(rows).items():
        current = None
        for _, pos, head, _, v in items:
            if head:
                current = None if v.startswith("v1") else v
            want.append((key, pos, current))
    value = F.when(~F.col("v").startswith("v1"), F.col("v"))
    df = O.fill_down(frame(spark, rows), ["k"], "pos", F.col("seen"), value, "day")
    assert sorted(got(df, "k", "pos", "day"), key=repr) == sorted(want, key=repr)


def test_line_groups(spark):
    lines = [
        "menu line before any date", "Jan. 5, 2024", "Statistics on prices", "Monthly report [PDF 1MB]", "Other [PDF 2MB]",
        "+ Jan. 6, 2024", "short", "Jan. 7, 2024", "Jan. 8, 2024", "first line", "a longer second line", "Jan. 9, 2024",
    ]
    df = spark.createDataFrame([("boj", i, t) for i, t in enumerate(lines)], "k string, pos bigint, line string")
    dated = F.col("line").rlike(r"^\+?\s*[A-Za-z]+\.\s*\d{1,2},\s*\d{4}")
    got_rows = got(O.line_groups(df, ["k"], "pos", "line", dated), "pos", "date_raw", "title", "category")
    assert got_rows == [
        (1, "Jan. 5, 2024", "Other [PDF 2MB]", "Statistics on prices"), (5, "+ Jan. 6, 2024", "short", ""),
        (7, "Jan. 7, 2024", "Jan. 8, 2024", ""), (8, "Jan. 8, 2024", "first line", "a longer second line"),
        (11, "Jan. 9, 2024", "", ""),
    ]


def test_newest_first(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), ("a", 3, "2024-01-02"), ("b", 0, "2023-01-01")], "k string, pos int, day string")
    assert [r["pos"] for r in O.newest_first(df, ["k"], "day", "pos").collect()] == [2, 3, 1, 0]


def test_spread_join_finds_every_row(spark):
    big = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    small = spark.createDataFrame([("hot", 1), ("4", 2)], "k string, x int")
    joined = O.spread_join(big, small, ["k"], "left", hot_rows=100)
    assert joined.count() == 1000
    assert joined.filter("x = 1").count() == 334 and joined.filter("x = 2").count() == 1
