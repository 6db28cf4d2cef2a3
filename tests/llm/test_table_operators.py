"""Operators over whole tables against plain versions of their definitions."""

import base64
import hashlib
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from helpers import awkward, frame, lower, words
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from articleflow.llm import archive, lm, mixing, repeats, rollup, simhash  # noqa: E402
from articleflow.llm.common import most_frequent  # noqa: E402
from articleflow.llm.components import components  # noqa: E402

# ---- archives --------------------------------------------------------------------------


def test_archives(spark):
    rows = [(3, "http://a/ b", "<p>é\r\n\r\nWARC/1.1\n</p>"), (1, "http://b", "<p>é\r\n\r\nWARC/1.1\n</p>"), (5, None, None), (4, "u", ""), (None, "v", ""), (7, "w", "HTTP/1.1 no head")]
    rows += [(8, "x", "y" * 3_000_000), (9, "x", "one"), (9, "x", "one"), (None, "x", "two"), (None, "x", "two")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")
    got = archive.archive(spark, pages.repartition(3)).collect()
    assert len(got) == len(rows)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter((i, len((t or "").encode()), sha(t)) for i, _, t in rows)
    by = {(r.page_id, r.payload_digest): r for r in got}
    assert (by[3, sha(rows[0][2])].record_type, by[3, sha(rows[0][2])].refers_to) == ("revisit", 1)
    assert by[1, sha(rows[1][2])].record_type == "response" and by[5, sha("")].refers_to == 4 and by[None, sha("")].refers_to == 4
    assert Counter(r.record_type for r in got if r.page_id == 9) == {"response": 1, "revisit": 1}
    assert len({r.record_id for r in got}) == len(rows) and {r.date for r in got} == {"2024-01-01T00:00:00Z"}
    assert archive.archive(spark, pages.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_lengths_decide(tmp_path, version):
    path = tmp_path / "x.arc"
    body = b"no head\nhttp://fake 0.0.0.0 20240101000000 text/plain 3\n"
    path.write_bytes(archive.arc_head(version, "x.arc", "2024") + b"\n" + archive.arc_record(version, "http://a/x y", "20240203", "text/plain", body) + archive.arc_record(version, "b", "2024", "t", b""))
    first, second = archive.read_arc(str(path))
    assert (first.url, first.content, second.content) == ("http://a/x y", body, b"")
    assert archive.warc_date(first.date) == "2024-02-03T00:00:00Z"
    path.write_bytes(path.read_bytes()[:-3])
    with pytest.raises(archive.ArchiveError):
        list(archive.read_arc(str(path)))
    path.write_bytes(b"3 0 x\n")
    with pytest.raises(archive.ArchiveError):
        list(archive.read_arc(str(path)))


# ---- near-duplicates -------------------------------------------------------------------


def plain_fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, bits=2):
    group = {v: {v} for v in values}
    for a in values:
        for b in values:
            if bin(a ^ b).count("1") <= bits and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    return group


def test_simhash(spark):
    rows = awkward(80)
    rows += [(300 + i, rows[5][1] + f" tail{i}", *rows[5][2:]) for i in range(6)]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    print_of = {i: plain_fingerprint(t) for i, t, *_ in rows if i is not None}
    group = plain_groups(set(print_of.values()) | {plain_fingerprint(t) for _, t, *_ in rows})
    assert len(got) == len(rows)
    for r in got:
        value = int(r.fingerprint, 16)
        assert r.doc_id is None or value == print_of[r.doc_id]
        assert r.component_id == min((i for i, v in print_of.items() if v in group[value]), default=None)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [50_000, 5])
def test_trie_join(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "NODE_ROWS", limit)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 6, dtype=np.int64)
    values = {int(b) for b in base} | {0, -1}
    for b in base:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            values.add(int(np.int64(b) ^ np.bitwise_xor.reduce(np.left_shift(np.int64(1), flips.astype(np.int64)))))
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    want = {(a, b) for a in values for b in values if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    assert len(got) == len(want) and {(min(r.a, r.b), max(r.a, r.b)) for r in got} == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(50)]
    got = components(spark.createDataFrame([*chain, *star, (5, 5), (3, 2), (3, 2)], "x long, y long")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(1, 301)} | {1001 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


# ---- repeated passages -----------------------------------------------------------------


def plain_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("limit", "parts"), [(20_000, 1), (2, 3)])
def test_repeats(spark, limit, parts):
    rows = awkward(40)
    rng = np.random.default_rng(2)
    core = "".join(map(chr, rng.integers(97, 123, 420)))
    for i in range(12):  # one passage, cut and framed in many ways
        a, b = rng.integers(0, 150), rng.integers(300, 420)
        frame_text = "".join(map(chr, rng.integers(97, 123, 200)))
        rows.append((400 + i, frame_text[:100] + core[a:b] + frame_text[100:], "en", "s", "0.5", "c", [i]))
    rows.append((500, "ß" * 199 + "x" + "ß" * 199, "de", "s", "0.5", "c", [0]))
    df = frame(spark, rows).repartition(parts)
    got = repeats.remove_repeats(df, limit=limit, outputs="digest").select("text", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = dict(zip([t for _, t, *_ in rows], plain_repeats([t for _, t, *_ in rows]), strict=True))
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.text]
    for r in repeats.remove_repeats(df, limit=limit).collect():
        data = (r.text or "").encode()
        assert sum(s["end"] - s["start"] for s in r.removed_spans) == r.n_removed and len(r.kept_text.encode()) >= len(data) - r.n_removed
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_long_texts_are_cut_in_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    text = bytes(rng.integers(97, 100, 5000).astype(np.uint8))
    h, c, first, last, a = repeats.regions(text)
    assert first[0] == 0 and last[-1] == len(text) - 200 and (first[1:] == last[:-1] + 1).all() and (a >= last).all() and (a - first <= 136).all()
    monkeypatch.setattr(repeats, "PIECE", 700)
    pieces = repeats.regions(text)
    anchor = {p: (x, y) for hs in (pieces,) for x, f, e, y in zip(hs[0], hs[2], hs[3], hs[4], strict=True) for p in range(f, e + 1)}
    assert all(anchor[p] == (x, y) for x, f, e, y in zip(h, first, last, a, strict=True) for p in range(f, e + 1))


# ---- language model --------------------------------------------------------------------


def test_lm(spark):
    df = frame(spark).withColumn("train", F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False)))
    got = lm.score(df, "train").collect()
    assert len(got) == len(awkward())
    train = Counter(t for r in got if r.train for t in [*words(lower(r.text)), None])
    n, v = sum(train.values()), len(train)
    for r in got:
        tokens = [*words(lower(r.text)), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in train for t in tokens), n)
        assert r.base_score == pytest.approx(sum(np.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
        assert r.score < 0 and r.bits_per_byte > 0
    ordinary = [r for r in got if r.doc_id is not None and 0 < r.doc_id < 60 and r.doc_id % 4 == 0]
    assert sum(r.score for r in ordinary) > sum(r.base_score for r in ordinary)


def test_lm_frequent_pairs_or_joined_ones_give_the_same(spark, monkeypatch):
    df = frame(spark).withColumn("train", F.lit(True))
    first = {(r.doc_id, r.text): r.score for r in lm.score(df, "train").collect()}
    monkeypatch.setattr(lm, "LOOKED_UP", 3)
    for r in lm.score(df, "train").collect():
        assert r.score == pytest.approx(first[r.doc_id, r.text], rel=1e-6)
    untrained = lm.score(df.withColumn("train", F.lit(False)), "train").where("doc_id = 203").first()
    assert untrained.train_tokens == 0 and untrained.score == pytest.approx(8 * np.log10(0.5), abs=0.3)


def test_lm_in_small_batches_gives_the_same(spark):
    df = frame(spark).withColumn("train", F.lit(True)).coalesce(1)
    first = sorted((str(r.doc_id), r.text or "", r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score(df, "train").collect())
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((str(r.doc_id), r.text or "", r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score(df, "train").collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [x[:4] for x in got] == [x[:4] for x in first]
    assert all(a[4] == pytest.approx(b[4], rel=1e-4) for a, b in zip(got, first, strict=True))


def test_probabilities_add_up():
    tokens = [b"a", b"ab", b"b", mixing.END] * 3
    topics = np.array([0, 1, 0, 1] * 3)
    counts = mixing.empty_counts()
    mixing.add_counts(counts, tokens, topics, np.ones(12), range(mixing.ORDERS))
    mixer = mixing.learn_mixer(counts, tokens, topics, np.ones(12))
    singles = [bytes([x]) for x in range(256) if x != 10]
    # All one-byte tokens, and the end: parts of a distribution over all tokens.
    p = 10 ** mixing.Model(counts, mixer).log10_probabilities([*singles, mixing.END], np.zeros(256, np.int64))
    assert 0.1 < p.sum() <= 1.0


# ---- token totals ----------------------------------------------------------------------


def test_rollup(spark, tmp_path):
    root = str(tmp_path / "totals")
    docs = spark.createDataFrame([(1, "a", "en", "x y. z"), (2, None, "en", "p q"), (3, "a", None, None), (4, "a", "en", "")], "doc_id long, source string, lang string, text string")
    counts = {v: rollup.counted(F.col("text"), v) for v in rollup.VERSIONS}
    rollup.commit(rollup.inserts(docs, counts), root, 1)
    rollup.commit(rollup.deletes(docs.where("doc_id = 2"), counts), root, 2)
    rollup.commit(rollup.revisions(docs.where("doc_id = 1"), counts, {v: n + 5 for v, n in counts.items()}), root, 3)
    rollup.commit(rollup.inserts(docs.limit(0), counts), root, 4)
    rollup.commit(rollup.deletes(docs.where("doc_id = 2"), counts), root, 2)  # a replay
    got = {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals(spark, root).collect()}
    assert got == {("a", "en", "words-1"): (2, 8), ("a", "en", "words-2"): (2, 9), ("a", None, "words-1"): (1, 0), ("a", None, "words-2"): (1, 0)}
    early = rollup.totals(spark, root, upto=1).where("source is null and version = 'words-1'").first()
    assert (early.n_docs, early.n_tokens) == (1, 2)
    for upto in (2, 2, 3):
        rollup.compact(spark, root, upto)
        rollup.commit(rollup.deletes(docs.where("doc_id = 2"), counts), root, 2)  # a replay of a settled batch
        assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals(spark, root).collect()} == got
    rollup.commit(rollup.deletes(docs.where("doc_id = 1"), counts), root, 5)
    assert {(r.source, r.lang, r.version): r.n_docs for r in rollup.totals(spark, root).collect()}["a", "en", "words-1"] == 1
    with pytest.raises(ValueError):
        rollup.totals(spark, root, upto=1)


def test_most_frequent(spark):
    df = spark.createDataFrame([(i, 1000 // (i + 1)) for i in range(500)] + [(999, 0), (998, None)], "k int, n long")
    got = [r.n for r in most_frequent(df, "n", 50).collect()]
    assert 40 <= len(got) <= 50 and min(got) >= 1000 // 51
    assert most_frequent(df, "n", 0).count() == 0


# ---- pipeline --------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    rows = awkward(60)
    rows.append((600, "the river stone with this that house water light of and from water", "en", "s", "", "", []))
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = [("b", "the river stone with this that house water light of and from water")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, str(tmp_path)).collect(), docs.schema)
        assert now.columns == docs.columns
        kept.append({r.doc_id: r for r in now.collect() if r.doc_id is not None})
    assert not {202, 203, 204, 205} & set(kept[0]) and set(range(60)) <= set(kept[0])
    group = plain_groups({plain_fingerprint(r.text) for r in kept[0].values()})
    least = {}
    for r in kept[0].values():
        key = min(group[plain_fingerprint(r.text)])
        least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert set(kept[1]) == set(least.values()) and 200 not in kept[1] and 201 not in kept[1]
    assert set(kept[2]) == set(kept[1]) and all(r.n_chars == len(r.text) for r in kept[2].values())
    assert 600 in kept[2] and 600 not in kept[3] and len(kept[3]) > 40
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in final if r.doc_id is not None} == set(kept[3])
