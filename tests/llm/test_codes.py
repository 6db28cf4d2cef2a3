"""Vector codes against plain rounds over all distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from articleflow.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, error array<int>"


def vectors(n=160, width=8, seed=2):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(rng.choice([-0.5, 0, 0.5]), 0.1))) for _ in range(width)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(n + i, rows[3][1], 1) for i in range(80)]  # a large group of copies
    rows += [(None, rows[5][1], None), (None, rows[6][1], 2), (7, rows[9][1], 2)]
    rows += [(900, None, 1), (901, [0.1] * (width - 1) + [None], 1), (902, [math.nan] * width, 1), (903, [math.inf] + [0.0] * (width - 1), None)]
    return [(i, v, la, "clash", [1]) for i, v, la, *_ in rows]


def plain(rows, parts, entries, rounds):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], la) for i, v, la, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((gap(cut(v, p), e), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        groups = [{} for _ in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                groups[p].setdefault(near(v, p)[1], []).append(cut(v, p))
        for p in range(parts):
            for j, members in groups[p].items():
                books[p][j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = []
    for i, v, la in kept:
        got = [near(v, p) for p in range(parts)]
        out.append((i, la, [j for _, j in got], sum(d for d, _ in got)))
    return out, books


@pytest.mark.parametrize(("parts", "entries"), [(4, 16), (2, 256), (1, 1)])
def test_compress(spark, parts, entries):
    rows = vectors()
    want, books = plain(rows, parts, entries, 4)
    coded, got_books = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=parts, entries=entries)
    got = coded.collect()
    assert got_books.tolist() == books
    key = lambda r: repr(tuple(r))
    assert sorted(got, key=key) == sorted(((i, la, c, e) for i, la, c, e in want), key=key)
    flat = ",".join(str(x) for p in books for e in p for x in e)
    assert codes.fingerprint(got_books) == hashlib.sha256(flat.encode()).hexdigest()


def test_decompress_gives_the_error(spark):
    rows = vectors(60)
    df = spark.createDataFrame(rows, SCHEMA).where("vec_id < 60")
    coded, books = codes.compress(df, entries=16)
    back = {r.vec_id: r for r in codes.decompress(coded, books).collect()}
    for r in codes.whole_vectors(df).where("vec_id <> 7").collect():
        assert sum((x - y) ** 2 for x, y in zip(r.ints, back[r.vec_id].ints, strict=True)) == back[r.vec_id].error


def test_empty_and_odd_lengths(spark):
    none, books = codes.compress(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and codes.fingerprint(books) == hashlib.sha256(b"").hexdigest()
    rows = [(1, [0.5] * 4, 1, "", []), (2, [0.5] * 8, 1, "", []), (3, [], None, "", []), (4, None, 1, "", [])]
    got = {r.vec_id: r for r in codes.compress(spark.createDataFrame(rows, SCHEMA))[0].collect()}
    assert set(got) == {1, 2, 3} and got[1].error == 0 and got[2].codes is None and got[3].error is None
    blank = codes.compress(spark.createDataFrame(rows[2:3], SCHEMA))[0].collect()
    assert [(r.codes, r.error) for r in blank] == [([0, 0, 0, 0], 0)]
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1, "", [])], SCHEMA))


def test_bounds_spare_searches_and_change_nothing():
    rng = np.random.default_rng(3)
    centers = rng.integers(-500, 500, (12, 4))
    x = (centers[rng.integers(0, 12, 3000)] + rng.integers(-30, 30, (3000, 4))).reshape(-1, 1, 4)
    history, state, tried = [x[:40].transpose(1, 0, 2).copy()], None, []
    for _ in range(5):
        bounds = codes.Bounds(history)
        state, searched = bounds.assign(x, state)
        tried.append(searched)
        exact = codes.squared(x[:, 0], history[-1][0])
        assert (state["near"][:, 0] == exact.argmin(1)).all()
        books = history[-1].copy()
        for j in np.unique(state["near"]):
            books[0, j] = x[state["near"][:, 0] == j, 0].sum(0) // (state["near"] == j).sum()
        history.append(books)
    assert tried[0] == 3000 and tried[-1] < 1500
    # Net moves are never longer than the sum of the moves between.
    moves = codes.Bounds(history).moved[0]
    steps = [np.sqrt(codes.own_squared(b[0], a[0])) for a, b in zip(history, history[1:], strict=False)]
    for since in range(len(history)):
        assert (moves[since] <= sum(steps[since:], np.zeros(40)) + 1e-9).all()


def test_huge_numbers_stay_exact():
    x = np.array([[1 << 30, 0], [(1 << 30) + 1, 0]], np.int64)
    assert codes.squared(x, x).tolist() == [[0, 1], [1, 0]]
    assert codes.squared(x, -x)[0, 0] == (1 << 31) ** 2
