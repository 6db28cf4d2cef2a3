"""BPE encoding and decoding with a compiled lexicon of frequent words.

The vocabulary file is read as it is: Unicode NFC, white space to one blank, lower case, split into
words, bytes as printable characters, merges with an end-of-word mark, no decoder. Frequent words
of the corpus are encoded once and compiled into transducers that the tasks map into memory;
any other word is merged pair by pair.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase, Sequence
from tokenizers.pre_tokenizers import Split

from articleflow.llm.common import add_columns, most_frequent
from articleflow.llm.files import Output
from articleflow.llm.transducer import Transducer, compile_words, map_shared
from articleflow.session import settle, work_dir

# Words in the lexicon and the transducers that share them; words that a task remembers twice over, and words
# it counts before passing them on.
LEXICON = 1 << 20
SHARDS = 8
MEMO = 200_000
COUNTED = 250_000
# Below this code point NFC changes nothing and lower case stays below or is no letter.
SIMPLE = 0x180
_NONE = 1 << 30
_COMPLEX = re.compile(f"[^\x00-{chr(SIMPLE - 1)}]")


def byte_characters() -> list[str]:
    """The printable character for each byte: itself if printable in Latin-1, else from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    chars = {b: chr(b) for b in own}
    for b in range(256):
        if b not in chars:
            chars[b] = chr(256 + len(chars) - len(own))
    return [chars[b] for b in range(256)]


@cache
def characters(name: str, below: int) -> str:
    """The characters of a class such as ``\\s``, as ranges for a bracket expression; asked of the
    library, whose Unicode version decides."""
    every = "".join(map(chr, [*range(min(below, 0xD800)), *range(0xE000, below)]))
    found = Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str(every)
    return "".join(f"{re.escape(x[0])}-{re.escape(x[-1])}" for x, _ in found)


@cache
def _splitter(pattern: str, below: int) -> re.Pattern:
    # Every one of these classes stands inside brackets there.
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(name, characters(name, below))
    return re.compile(pattern)


class Vocabulary:
    """The tokenizer in ``path``: special strings, splitting, merges and token names."""

    def __init__(self, path: str):
        content = json.loads(Path(path).read_text())
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.single = [self.ids[c] for c in chars]
        self.closing = [self.ids[c + end] for c in chars]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {self.ids[a] << 20 | self.ids[b]: i for i, (a, b) in enumerate(pairs)}
        self.result = [self.ids[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        split = next(p for p in content["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.split = split
        self.simple = _splitter(split, SIMPLE)
        self.normal = Sequence([NFC(), Lowercase()]).normalize_str
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """Words of a text without special strings; blanks only part them, so runs can stay."""
        if _COMPLEX.search(text):
            return _splitter(self.split, sys.maxunicode + 1).findall(self.normal(text))
        return self.simple.findall(text.lower())

    def pieces(self, text: str) -> list[str]:
        """Words, and special strings as they are, in order."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out.extend([part] if part in self.special else self.words(part))
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the pair of lowest rank is merged, the leftmost of equals first, until
        no pair is left to merge."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode()
        if not data:
            return []
        parts = [self.single[b] for b in data[:-1]]
        parts.append(self.closing[data[-1]])
        rank_of, result = self.ranks.get, self.result
        ranks = [rank_of(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != _NONE:
            i = ranks.index(least)
            parts[i : i + 2] = [result[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << 20 | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] << 20 | parts[i + 1], _NONE)
        return parts


class Encoder(dict):
    """Words to (number of ids, ids, token names): memory, then transducer, then merges."""

    def __init__(self, vocabulary: Vocabulary, lexicon: list[Transducer] | None):
        super().__init__()
        self.vocabulary = vocabulary
        self.lexicon = lexicon or []
        self.older: dict[str, tuple[int, str, str]] = {}

    def __missing__(self, word: str) -> tuple[int, str, str]:
        got = self.older.get(word) or self.looked_up(word) or self.merged(word)
        if len(self) >= MEMO:
            # Words used since the last time stay; those before them go.
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got

    def looked_up(self, word: str) -> tuple[int, str, str] | None:
        if not self.lexicon:
            return None
        content = word.encode()
        shard = self.lexicon[crc32(content) % len(self.lexicon)]
        number = shard.find(content)
        if number < 0:
            return None
        ids, names = shard.text(number).split("\n")
        return ids.count(" ") + 1, ids, names

    def merged(self, word: str) -> tuple[int, str, str]:
        ids, names = self.vocabulary.merge(word), self.vocabulary.names
        return len(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids])

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids and token names, each joined by one blank."""
        found = list(map(self.__getitem__, self.vocabulary.pieces(text)))
        if not found:
            return 0, "", ""
        counts, ids, names = zip(*found, strict=True)
        return sum(counts), " ".join(ids), " ".join(names)


def word_counts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Rows (word, n) over all texts; each task adds up before the shuffle, in bounded parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Vocabulary(path).pieces
        counts: Counter = Counter()

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(pieces(t or ""))
                if len(counts) >= COUNTED:
                    yield part()
                    counts.clear()
        if counts:
            yield part()

    return df.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(df: DataFrame, path: str, text: str = "text", size: int = LEXICON, shards: int = SHARDS) -> str:
    """Compile the most frequent words of all texts, at most ``size``; a folder in the shared one.

    The words are dealt out by a hash to ``shards`` transducers, each compiled by one task; a
    shard has about ``size / shards`` words, whatever the corpus.
    """
    folder = work_dir(df.sparkSession, "lexicon")
    rows = most_frequent(settle(word_counts(df, path, text), "words"), "n", size)
    dealt = rows.select("word", F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(shards)).cast("int").alias("shard"))
    every = df.sparkSession.range(shards).select(F.lit(None).cast("string").alias("word"), F.col("id").cast("int").alias("shard"))

    def compiled(t: pa.Table) -> pa.Table:
        vocabulary = Vocabulary(path)
        shard = t.column("shard")[0].as_py()
        merged = {w: vocabulary.merge(w) for w in t.column("word").to_pylist() if w is not None}
        names = vocabulary.names
        texts = {w.encode(): " ".join(map(str, ids)) + "\n" + " ".join([names[i] for i in ids]) for w, ids in merged.items()}
        with Output(f"{folder}/{shard:04d}.bin") as out:
            out.write(compile_words({w.encode(): ids for w, ids in merged.items()}, texts))
        return pa.table({"shard": pa.array([shard], pa.int32())})

    # One task for each transducer, also where there are few words.
    made = dealt.union(every).repartition(shards, "shard").groupBy("shard").applyInArrow(compiled, "shard int")
    if made.agg(F.sum("shard")).first()[0] != shards * (shards - 1) // 2:
        raise RuntimeError("a part of the lexicon is missing")
    return f"{folder}#{shards}"


def open_lexicon(place: str) -> list[Transducer]:
    folder, shards = place.rsplit("#", 1)
    return [Transducer(map_shared(f"{folder}/{i:04d}.bin")) for i in range(int(shards))]


def encode(df: DataFrame, path: str, lexicon: str | None = None, text: str = "text", keep: list[str] | None = None, outputs: str = "digests") -> DataFrame:
    """``df`` with its texts encoded and decoded.

    ``outputs="texts"`` gives n_tokens, ids (array) and decoded (text); ``"digests"`` gives
    n_tokens and the SHA-256 of the ids (decimal, one blank between) and of the decoded text.
    Results don't depend on ``lexicon``. Null and empty texts have no ids; special strings inside
    a text are single tokens; there is no length limit, and repeated rows are encoded alike.
    """
    texts = outputs == "texts"

    def make():
        encoder = Encoder(Vocabulary(path), open_lexicon(lexicon) if lexicon else None)

        def sha(s: str) -> str:
            return hashlib.sha256(s.encode()).hexdigest()

        def work(column):
            got = [encoder.encode(t or "") for t in column.to_pylist()]
            if texts:
                return [[n for n, _, _ in got], [list(map(int, ids.split())) for _, ids, _ in got], [names for _, _, names in got]]
            return [[n for n, _, _ in got], [sha(ids) for _, ids, _ in got], [sha(names) for _, _, names in got]]

        return work

    if texts:
        fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    else:
        fields = [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return add_columns(df, [T.StructField("n_tokens", T.LongType()), *fields], make, [text], keep)
