"""Operators on single texts against plain versions of their definitions."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from helpers import awkward, frame, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from articleflow.llm import bpe, decontaminate, language, quality, textstats, toxicity
from articleflow.llm.transducer import Transducer, compile_words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- language --------------------------------------------------------------------------


def test_language(spark):
    df = frame(spark)
    got = {r.doc_id: r for r in language.predict(df, language.fit(df)).collect()}
    assert got[0].lang_pred == "de" and got[1].lang_pred == "en"
    assert {got[i].lang_pred for i in (202, 203, 204, 205)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5].extra == [5]
    right = [got[i].lang_pred == ("en" if i % 3 else "de") for i in range(60)]
    assert sum(right) >= 57


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    found = language.predict(docs.where("held"), language.fit(docs.where("not held"))).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


def test_language_without_anything_to_learn(spark):
    df = frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict(df, language.fit(df)).collect()} == {"und"}
    assert language.predict(frame(spark, []), None).count() == 0


# ---- quality ---------------------------------------------------------------------------


def plain_counts(text):
    found = words(text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    again = {j for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(again)


@given(st.text(alphabet="ab \n\t#é", max_size=200))
@settings(max_examples=200, deadline=None)
def test_base_counts(text):
    found, *rest = textstats.counts(text.encode())
    assert (len(found), *rest) == plain_counts(text)


def test_quality(spark):
    df = frame(spark)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1), (3, None), (7, 1)], "doc_id long, quality int")
    got = quality.judge(df, quality.fit(df, labels)).collect()
    assert len(got) == len(awkward())
    for r in got:
        want = plain_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)
    long = [r for r in got if not r.base_failed and r.doc_id is not None and r.doc_id < 60]
    assert sum(r.kept == (r.doc_id % 3 > 0) for r in long) >= 0.9 * len(long)
    none = quality.fit(df, labels.limit(0))
    assert quality.judge(frame(spark, []), none).count() == 0


# ---- decontamination -------------------------------------------------------------------


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("patterns", [100_000, 7])
def test_decontaminate(spark, patterns):
    texts = {r[1] for r in awkward() if r[1]}
    some = sorted(texts, key=len)[-6]
    items = [(1, some[: len(some) // 2].upper()), (2, "river stone"), (3, None), (4, ""), (5, "..."), (None, "Über! licht"), (2, "river stone"), (6, "x" * 700)]
    df = frame(spark)
    rows = decontaminate.benchmark_hits(df, spark.createDataFrame(items, "item_id int, text string"), patterns=patterns).collect()
    grams = {}
    for k, t in items:
        w = plain_words(t)
        for i in range(max(1, len(w) - 9)) if w else []:
            grams.setdefault(tuple(w[i : i + 10]), set()).add("" if k is None else str(k))
    sizes = {len(g) for g in grams}
    hits = 0
    for r in rows:
        w = plain_words(r.text)
        found, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    found.update(range(i, i + n))
                    names |= grams[tuple(w[i : i + n])]
        runs = {j for x in r.hit_runs for j in range(x["first"], x["last"] + 1)}
        assert (r.n_words, runs, r.hit_items) == (len(w), found, sorted(names))
        parts = [w[x["first"] : x["last"] + 1] for x in r.hit_runs]
        assert [plain_words(r.text[s["start"] : s["end"]]) for s in r.hit_spans] == parts
        hits += bool(found)
    assert hits > 3


# ---- toxicity --------------------------------------------------------------------------


def plain_segments(values):
    """Maximal segments by their recursive definition: the best one, then both sides."""
    best = None
    for i in range(len(values)):
        total = 0.0
        for j in range(i, len(values)):
            total += values[j]
            if total > 0 and (best is None or total > best[2] + 1e-12):
                best = (i, j, total)
    if best is None:
        return []
    a, b, _ = best
    right = [(i + b + 1, j + b + 1, s) for i, j, s in plain_segments(values[b + 1 :])]
    return [*plain_segments(values[:a]), best, *right]


@given(st.lists(st.sampled_from([-0.37, 1.01, 2.3, 0.513]), max_size=14))
@settings(max_examples=200, deadline=None)
def test_segments(values):
    at = [i for i, v in enumerate(values) if v > 0]
    got = toxicity.segments(at, [values[i] for i in at], 0.37)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(values)]


def test_toxicity(spark):
    rows = [(i, f"{t or ''} {'zork blarg ' * ((i or 1) % 4 == 0)}" if t is not None else None, *rest) for i, t, *rest in awkward(200)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)], "doc_id long, toxic int")
    got = toxicity.score(df, toxicity.fit(df, labels)).collect()
    assert len(got) == len(rows)
    fresh = [r for r in got if r.doc_id is not None and 150 <= r.doc_id < 200 and r.doc_id not in (100, 101)]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in fresh) >= 0.9 * len(fresh)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    marked = [r for r in fresh if r.toxic_passages]
    assert marked and all("zork" in r.text[p["start"] : p["end"]] for r in marked for p in r.toxic_passages)
    flat = toxicity.fit(df, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(df, flat).collect()} == {0}


# ---- BPE -------------------------------------------------------------------------------

REFERENCE = Tokenizer.from_file(VOCABULARY)


def library(text):
    e = REFERENCE.encode(text or "", add_special_tokens=False)
    return list(e.ids), REFERENCE.decode(e.ids, skip_special_tokens=False)


@given(st.lists(st.text(max_size=12) | st.sampled_from(["The", "don't", "ΣΑΣ", "İ", "<|endoftext|>", "́e", "１２", "a b", "ﬁ", "한"]), max_size=6))
@settings(max_examples=300, deadline=None)
def test_encode_like_the_library(parts):
    text = "".join(parts)
    n, ids, names = ENCODER.encode(text)
    want, decoded = library(text)
    assert (n, list(map(int, ids.split())), names) == (len(want), want, decoded)


ENCODER = bpe.Encoder(bpe.Vocabulary(VOCABULARY), None)


@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 1000), min_size=1, max_size=3), max_size=40), st.binary(max_size=6))
@settings(max_examples=200, deadline=None)
def test_transducer(table, other):
    lexicon = Transducer(memoryview(compile_words(table)))
    assert all(lexicon.get(w) == ids for w, ids in table.items())
    assert lexicon.get(other) == table.get(other)


def test_bpe(spark):
    df = frame(spark)
    digests = bpe.encode(df, VOCABULARY, bpe.build_lexicon(df, VOCABULARY), keep=["text"]).collect()
    texts = bpe.encode(df, VOCABULARY, outputs="texts").collect()
    for r, t in zip(digests, texts, strict=True):
        ids, decoded = library(r.text)
        assert (t.n_tokens, t.ids, t.decoded) == (len(ids), ids, decoded) and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode(frame(spark, []), VOCABULARY).count() == 0
