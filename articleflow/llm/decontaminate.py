"""Benchmark decontamination by an Aho-Corasick automaton over normalised item words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleflow.llm.common import add_columns, raw
from articleflow.session import settle

WINDOW = 10
# Patterns in one automaton; more items take further passes.
PATTERNS = 100_000
# Digits, letters and all bytes of non-ASCII characters stay, A-Z become a-z, the rest parts words.
# One byte for one byte, so offsets hold in the original text.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

Block = dict[tuple[bytes, ...], set[str]]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Every run of ``size`` words; all words if there are fewer, nothing if there are none."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def blocks(items: DataFrame, text: str, item_id: str, size: int, patterns: int) -> Iterator[Block]:
    """Windows with the items they come from, in bounded parts; one empty part if there are none.

    The rows come to the driver one Spark partition after another.
    """
    block: Block = {}
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(text).cast("binary"))
    made = False
    for name, content in rows.toLocalIterator():
        for w in windows(words_of(bytes(content or b"")), size):
            block.setdefault(w, set()).add(name)
            if len(block) >= patterns:
                yield block
                block, made = {}, True
    if block or not made:
        yield block


class Scanner:
    """The automaton over one block; words are numbered, unknown words are 0."""

    def __init__(self, block: Block):
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for w, names in block.items():
            key = tuple(self.numbers.setdefault(x, len(self.numbers) + 1) for x in w)
            self.automaton.add_word(key, (len(w), names))
        if block:
            self.automaton.make_automaton()
        self.empty = not block

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words (first, last) and the items found."""
        if self.empty or not words:
            return [], set()
        number = self.numbers.get
        runs: list[tuple[int, int]] = []
        found: set[str] = set()
        for end, (n, names) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            found |= names
            runs.append((end - n + 1, end))
        return merged(runs), found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def spans_of(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word runs as character offsets (start, end) in the original text."""
    if not runs:
        return []
    at = np.array([m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_BYTES))])
    # Characters before a byte offset: bytes that don't continue a character.
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(chars[at[a, 0]]), int(chars[at[b, 1]])) for a, b in runs]


_RUN = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_runs", _RUN),
    T.StructField("hit_spans", _SPAN),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def benchmark_hits(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    size: int = WINDOW,
    patterns: int = PATTERNS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with n_words, hit_runs (word numbers), hit_spans (characters) and hit_items.

    One automaton over all windows of the items scans each text once. Items beyond
    ``patterns`` windows go to further automata, each in a pass of its own that adds to the
    results so far. Null and empty texts have no words and no hits; an item without words has
    no window; an item without id is listed as empty text. Repeated items and repeated rows
    count as they stand; columns of ``df`` with the names of the new ones give way.
    """
    names = [f.name for f in _FIELDS]
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    out = df
    for k, block in enumerate(blocks(items, item_text, item_id, size, patterns)):
        shared = df.sparkSession.sparkContext.broadcast(block)
        again = k > 0
        if again:
            out = settle(out, "hits")

        def make(shared=shared, again=again):
            scanner = Scanner(shared.value)

            def work(column, *before):
                rows = []
                texts = raw(column)
                runs_before, items_before = ([c.to_pylist() for c in before]) if again else ([[]] * len(texts),) * 2
                for t, r, i in zip(texts, runs_before, items_before, strict=True):
                    words = words_of(t)
                    runs, found = scanner.scan(words)
                    if r:
                        runs = merged(runs + [(x["first"], x["last"]) for x in r])
                    rows.append((len(words), runs, spans_of(t, runs), sorted(found | set(i))))
                return [
                    [r[0] for r in rows],
                    [[{"first": a, "last": b} for a, b in r[1]] for r in rows],
                    [[{"start": a, "end": b} for a, b in r[2]] for r in rows],
                    [r[3] for r in rows],
                ]

            return work

        inputs = [text] + (["hit_runs", "hit_items"] if again else [])
        out = add_columns(out, _FIELDS, make, inputs, keep=list(dict.fromkeys([*keep, text])))
    return out.select(*keep, *names)


def n_hit(runs: str = "hit_runs"):
    """Number of hit words."""
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
