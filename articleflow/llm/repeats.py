"""Removal of repeated byte strings by sorting suffixes.

Every byte that lies in a string of LENGTH bytes which also starts elsewhere is found, exactly.
Sorting all suffixes of a large corpus is not needed for that. A window of LENGTH bytes has one
anchor, the leftmost of its KEY-byte strings with the smallest hash; equal windows have equal
anchors at equal places. So only windows whose anchor string occurs again can repeat, and a run of
windows with one anchor (a region) is decided together:

1. Each task writes its rows to a chunk file in the shared folder and hashes its regions. Regions
   that occur twice in the batch are decided at once, so a passage that very many documents
   share leaves one row for each batch.
2. The others meet by anchor. Equal regions are decided; regions that share only the anchor stay.
3. Of these the bytes are taken from the chunks. Sampled splitters range-partition them by the
   leading bytes of the anchored suffix, and each bucket sorts the suffixes that start at the
   regions' windows by multikey quicksort on eight-byte tokens until they differ or LENGTH bytes
   agree. Anchors with very many regions are cut into slices, whose windows are compared
   across the cuts by their hashes.
4. Each chunk gets its decisions and is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from articleflow.llm.common import raw
from articleflow.llm.files import Output
from articleflow.session import settle, work_dir

LENGTH = 200
KEY = 64
# Texts are hashed in pieces of so many windows.
PIECE = 1 << 18
# Regions of one anchor that one bucket compares.
SLICE = 20_000
# Windows that one bucket sorts at a time.
SORTED = 4_000_000

RUN, ROW, MARK, REGION, CHUNK = range(5)
_ROWS = "key long, kind int, h long, c long, chunk long, row int, at long, n int"
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
_NAMES = ["key", "kind", "h", "c", "chunk", "row", "at", "n"]
_BASE = 0x9E3779B97F4A7C15


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, and the powers of the base and of its inverse modulo 2^64."""
    values = np.random.default_rng(200).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    n = PIECE + 2 * LENGTH
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    one = np.ones(1, np.uint64)
    return values, np.cumprod(np.concatenate([one, np.full(n, base)]), dtype=np.uint64), np.cumprod(np.concatenate([one, np.full(n, inverse)]), dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _slide(pick: Callable, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    n, size = len(x) - width + 1, 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:n], x[width - size : width - size + n]) if size < width else x[:n]


def _piece_regions(b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, region hash, first window, last window, anchor of each region of a piece."""
    values, powers, inverses = _tables()
    n, width = len(b), LENGTH - KEY + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[b] * powers[:n], dtype=np.uint64)])
    h = _mix((sums[KEY:] - sums[:-KEY]) * inverses[: n - KEY + 1])
    least = _slide(np.minimum, h, width)
    pad = np.zeros(width - 1, np.uint64)
    anchors = np.flatnonzero(h == _slide(np.maximum, np.concatenate([pad, least, pad]), width))
    # The first anchor of each window that has the window's smallest hash.
    ah = h[anchors]
    at = np.searchsorted(anchors, np.arange(len(least)))
    todo = np.flatnonzero(ah[at] != least)
    while len(todo):
        at[todo] += 1
        todo = todo[ah[at[todo]] != least[todo]]
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(least) - 1]])
    a = anchors[at[first]]
    shape = ((a - first) * 1024 + (last - first)).astype(np.uint64)
    c = _mix(((sums[last + LENGTH] - sums[first]) * inverses[first]) ^ (shape * np.uint64(0xC2B2AE3D27D4EB4F)))
    return h[a], c, first, last, a


def regions(text: bytes) -> tuple[np.ndarray, ...] | None:
    """Regions of a text; None if it is shorter than LENGTH."""
    if len(text) < LENGTH:
        return None
    b = np.frombuffer(text, np.uint8)
    parts = []
    for s in range(0, len(b) - LENGTH + 1, PIECE):
        h, c, first, last, a = _piece_regions(b[s : s + PIECE + LENGTH - 1])
        parts.append((h, c, first + s, last + s, a + s))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _packed(first: np.ndarray, last: np.ndarray, a: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 16 | (a - first).astype(np.int64) << 8 | (last - first).astype(np.int64)


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = at >> 16
    return first, first + (at & 255), first + ((at >> 8) & 255)


def _joined(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows, neighbours in one row made one; sorted by row and place."""
    if not len(row):
        return row, first, last
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (first[1:] > last[:-1] + 1)])
    start = np.flatnonzero(new)
    return row[start], first[start], np.maximum.reduceat(last, start)


def _rows(**columns) -> pa.RecordBatch:
    n = max(len(v) for v in columns.values() if isinstance(v, np.ndarray))
    full = [columns.get(name, 0) for name in _NAMES]
    full = [v if isinstance(v, np.ndarray) else np.full(n, v, np.int64) for v in full]
    full = [v.view(np.int64) if v.dtype == np.uint64 else v for v in full]
    return pa.RecordBatch.from_arrays([pa.array(v.astype(t.to_pandas_dtype()), t) for v, t in zip(full, _TYPES, strict=True)], names=_NAMES)


def _run_rows(chunk, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    at = first.astype(np.int64) << 32 | last.astype(np.int64)
    return _rows(key=_mix(at.view(np.uint64)), kind=RUN, chunk=chunk, row=row, at=at)


def _scan(folder: str, text: str):
    """Batches to chunk files and rows; see step 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            # A task that runs again gives the same numbers and replaces its files.
            chunk = part << 32 | number
            with Output(f"{folder}/{chunk:016x}.arrow") as out:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(batch)
                out.write(sink.getvalue())
            yield _rows(key=np.array([chunk]), kind=CHUNK, chunk=chunk)
            found = [(i, r) for i, t in enumerate(raw(batch.column(batch.schema.names.index(text)))) if (r := regions(t)) is not None]
            if not found:
                continue
            row = np.repeat([i for i, _ in found], [len(r[0]) for _, r in found]).astype(np.int64)
            h, c, first, last, a = (np.concatenate(x) for x in zip(*(r for _, r in found), strict=True))
            order = np.lexsort((c, h))
            h, c, first, last, a, row = (x[order] for x in (h, c, first, last, a, row))
            new_h = np.concatenate([[True], h[1:] != h[:-1]])
            start = np.flatnonzero(new_h | np.concatenate([[True], c[1:] != c[:-1]]))
            n = np.diff(np.append(start, len(h)))
            twice = np.repeat(n > 1, n)
            if twice.any():
                yield _run_rows(chunk, *_joined(row[twice], first[twice], last[twice]))
            # One row for each distinct region; several of one anchor go on as they are.
            group = np.cumsum(new_h)[start]
            several = np.bincount(group)[group] > 1
            at = _packed(first[start], last[start], a[start])
            h, c, row = h[start], c[start], row[start]
            one = ~several
            if one.any():
                yield _rows(key=h[one], kind=ROW, h=h[one], c=c[one], chunk=chunk, row=row[one], at=at[one], n=n[one])
            if several.any():
                mark = np.unique(h[several])
                yield _rows(key=mark, kind=MARK, h=mark, chunk=chunk)
                yield _rows(key=_mix(c[several]), kind=REGION, h=h[several], c=c[several], chunk=chunk, row=row[several], at=at[several], n=n[several])

    return run


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that met by anchor: runs of equal regions, and regions left to compare; see step 2."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    _, kind, h, c, chunk, row, at, n = (t.column(i).to_numpy() for i in range(8))
    passing = (kind == RUN) | (kind == REGION) | (kind == CHUNK)
    if passing.any():
        yield from t.filter(pa.array(passing)).combine_chunks().to_batches()
    here = ~passing
    if not here.any():
        return
    kind, h, c, chunk, row, at, n = (x[here] for x in (kind, h, c, chunk, row, at, n))
    order = np.lexsort((kind, c, h))
    kind, h, c, chunk, row, at, n = (x[order] for x in (kind, h, c, chunk, row, at, n))
    new_h = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new_h) - 1
    marked = np.bincount(group, kind == MARK)[group] > 0
    new = new_h | np.concatenate([[True], (c[1:] != c[:-1]) | (kind[1:] != kind[:-1])])
    same = np.cumsum(new) - 1
    total = np.bincount(same, n)[same]
    distinct = np.bincount(group, new & (kind == ROW))[group]
    own = kind == ROW
    full = own & (total > 1) & (n == 1)
    if full.any():
        first, last, _ = _unpacked(at[full])
        yield _run_rows(chunk[full], row[full], first, last)
    left = own & new & ((distinct > 1) | marked)
    if left.any():
        yield _rows(key=0, kind=REGION, h=h[left], c=c[left], chunk=chunk[left], row=row[left], at=at[left], n=np.minimum(total[left], 2))


def _chunk(folder: str, chunk: int) -> pa.RecordBatch:
    system, place = fs.FileSystem.from_uri(f"{folder}/{chunk:016x}.arrow")
    with system.open_input_file(place) as f, pa.ipc.open_stream(f.read()) as reader:
        return reader.read_next_batch()


_BYTES = "h long, c long, chunk long, row int, at long, lead long, bytes binary"


def _take_bytes(folder: str, text: str):
    def run(t: pa.Table) -> pa.Table:
        chunk = t.column("chunk")[0].as_py()
        texts = raw(_chunk(folder, chunk).column(text))
        at, row = t.column("at").to_numpy(), t.column("row").to_numpy()
        first, last, a = _unpacked(at)
        pieces = [texts[r][f : e + LENGTH] for r, f, e in zip(row, first, last, strict=True)]
        lead = [int.from_bytes(p[x : x + 8], "big", signed=True) for p, x in zip(pieces, a - first, strict=True)]
        return pa.table({"h": t.column("h"), "c": t.column("c"), "chunk": t.column("chunk"), "row": t.column("row"), "at": t.column("at"), "lead": pa.array(lead, pa.int64()), "bytes": pa.array(pieces, pa.binary())})

    return run


def equal_suffixes(data: np.ndarray, group: np.ndarray, start: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Numbers of the suffixes whose first ``length`` bytes equal those of another of their group.

    Multikey quicksort on eight-byte tokens, all groups in step: suffixes are ordered by their
    next token inside their group, each run of equal tokens becomes a group, groups of one are
    done. Suffixes are places in ``data``, which goes on for eight bytes behind the last.
    """
    tokens = np.ndarray((len(data) - 7,), np.dtype(">u8"), data, 0, (1,))
    live = np.arange(len(start))
    _, group = np.unique(group, return_inverse=True)
    offset = 0
    while len(live):
        alone = np.bincount(group)[group] < 2
        live, group = live[~alone], group[~alone]
        if offset >= length or not len(live):
            break
        step = min(offset, length - 8)  # the last token may overlap the one before
        token = tokens[start[live] + step].astype(np.uint64)
        order = np.lexsort((token, group))
        live, group, token = live[order], group[order], token[order]
        group = np.cumsum(np.concatenate([[True], (group[1:] != group[:-1]) | (token[1:] != token[:-1])])) - 1
        offset += 8
    return live


_WINDOWS = "kind int, h long, i int, w1 long, w2 long, chunk long, row int, first long, last long, open boolean"
_WINDOW_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]


def _window_batch(n: int, **columns) -> pa.RecordBatch:
    names = [x.split()[0] for x in _WINDOWS.split(", ")]
    arrays = []
    for name, t in zip(names, _WINDOW_TYPES, strict=True):
        v = columns.get(name, 0)
        v = v if isinstance(v, np.ndarray) else np.full(n, v)
        arrays.append(pa.array(v.astype(t.to_pandas_dtype()), t))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _hashes(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the LENGTH bytes at each place."""
    tokens = np.ndarray((len(data) - 7,), np.dtype(">u8"), data, 0, (1,))
    w1, w2 = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    for offset in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        t = tokens[start + offset].astype(np.uint64)
        w1 = _mix((w1 ^ t) * np.uint64(_BASE))
        w2 = _mix((w2 + t) * np.uint64(0xC2B2AE3D27D4EB4F))
    return w1.view(np.int64), w2.view(np.int64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: runs of repeated windows, and the windows of sliced anchors; see step 3."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    h, chunk, row, at, part, parts = (t.column(n).to_numpy() for n in ("h", "chunk", "row", "at", "slice", "slices"))
    pieces = t.column("bytes").to_pylist()
    order = np.lexsort((part, h))
    new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (part[order][1:] != part[order][:-1])])
    group = np.empty(len(h), np.int64)
    group[order] = np.cumsum(new)
    first, last, a = _unpacked(at)
    windows = last - first + 1
    # Whole groups, so many windows at a time.
    share = np.zeros(len(h), np.int64)
    share[order] = (np.cumsum(windows[order]) - windows[order]) // SORTED
    leader = np.zeros(group.max() + 1, np.int64)
    np.maximum.at(leader, group, share)
    for k in np.unique(leader[group]):
        mine = np.flatnonzero(leader[group] == k)
        lengths = np.array([len(pieces[i]) for i in mine])
        base = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join([*(pieces[i] for i in mine), bytes(8)]), np.uint8)
        w = windows[mine]
        owner = np.repeat(np.arange(len(mine)), w)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(w) - w, w)
        start = base[owner] + step
        before = (a[mine] - first[mine])[owner] - step + LENGTH  # place of the anchor in the window, made positive
        live = equal_suffixes(data, group[mine][owner] * 2048 + before, start)
        place = first[mine][owner] + step
        if len(live):
            r, f, e = _joined(owner[live], place[live], place[live])
            yield _window_batch(len(r), kind=RUN, chunk=chunk[mine][r], row=row[mine][r], first=f, last=e)
        cut = np.flatnonzero((parts[mine] > 1)[owner])
        if len(cut):
            repeated = np.zeros(len(owner), bool)
            repeated[live] = True
            w1, w2 = _hashes(data, start[cut])
            same = np.lexsort((w2, w1, before[cut], group[mine][owner[cut]]))
            cut, w1, w2 = cut[same], w1[same], w2[same]
            table = np.stack([group[mine][owner[cut]], before[cut], w1, w2])
            keep = np.concatenate([[True], (table[:, 1:] != table[:, :-1]).any(0)])
            cut, w1, w2 = cut[keep], w1[keep], w2[keep]
            p = place[cut]
            o = owner[cut]
            yield _window_batch(len(cut), kind=ROW, h=h[mine][o], i=before[cut], w1=w1, w2=w2, chunk=chunk[mine][o], row=row[mine][o], first=p, last=p, open=~repeated[cut])


def _repeated_windows(found: DataFrame, folder: str, text: str, limit: int, tasks: int) -> DataFrame:
    """Runs (chunk, row, first, last) of the regions that were left to compare."""
    taken = found.where(F.col("kind") == REGION).repartition(tasks, "chunk").groupBy("chunk").applyInArrow(_take_bytes(folder, text), _BYTES)
    taken = settle(taken, "regions")
    large = taken.groupBy("h").agg(F.count("*").alias("size")).where(F.col("size") > limit)
    slices = F.coalesce(F.ceil(F.col("size") / limit), F.lit(1)).cast("long")
    # At most one anchor in ``limit`` rows is that large.
    cut = taken.join(F.broadcast(large), "h", "left").select("*", slices.alias("slices")).drop("size")
    cut = cut.withColumn("slice", F.pmod("c", F.col("slices")))
    n = max(1, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    windows = settle(cut.repartitionByRange(n, "lead", "h", "slice").mapInArrow(_compare, _WINDOWS), "windows")
    runs = windows.where(F.col("kind") == RUN).select("chunk", "row", "first", "last")
    # One row for each window and slice at most, so the lists are as short as there are slices.
    across = windows.where(F.col("kind") == ROW).groupBy("h", "i", "w1", "w2")
    met = across.agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("open"), F.struct("chunk", "row", "first", "last"))).alias("places"))
    return runs.union(met.where("n > 1").select(F.inline("places")))


def kept_parts(text: bytes, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal removed runs (start, end) in bytes, from sorted runs of windows."""
    out: list[list[int]] = []
    for f, e in zip(first.tolist(), last.tolist(), strict=True):
        if out and f <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e + LENGTH)
        else:
            out.append([f, e + LENGTH])
    return [(s, e) for s, e in out]


def _whole(text: bytes, at: int, step: int) -> int:
    """``at`` moved by ``step`` to where a character begins."""
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at += step
    return at


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def remove_repeats(df: DataFrame, text: str = "text", keep: list[str] | None = None, limit: int = SLICE, outputs: str = "text") -> DataFrame:
    """``df`` with n_bytes, n_removed, n_spans, and its texts cut.

    A byte is removed if a string of LENGTH bytes over it also starts anywhere else in the
    table, in the same text or another; all occurrences go. Strings never cross texts and are
    judged on the input. ``outputs="text"`` gives kept_text, in which a character that is removed
    only in part stays, and removed_spans (bytes); ``"digest"`` gives kept_sha256 of the remaining bytes.
    ``df`` is best a stored table: a task that has to run again must read the same rows in the same order.
    Null and empty texts have no bytes. Repeated rows repeat each other and are removed. The
    result has one row for each row; columns of ``df`` with the new names give way.
    """
    spark = df.sparkSession
    extra = [T.StructField("kept_text", T.StringType()), T.StructField("removed_spans", _SPANS)] if outputs == "text" else [T.StructField("kept_sha256", T.StringType())]
    fields = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + extra
    keep = [c for c in (df.columns if keep is None else keep) if c not in {f.name for f in fields}]
    source = df.select(*dict.fromkeys([*keep, text]))
    folder = work_dir(spark, "chunks")
    rows = source.mapInArrow(_scan(folder, text), _ROWS)
    found = settle(rows.repartition("key").mapInArrow(_decide, _ROWS), "decided")
    runs = found.where(F.col("kind") == RUN).select("chunk", "row", F.shiftright("at", 32).alias("first"), F.col("at").bitwiseAND((1 << 32) - 1).alias("last"))
    chunks = found.where(F.col("kind") == CHUNK).select("chunk", F.lit(-1).alias("row"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("last"))
    # The decisions are small beside the texts they open: their size must not set the number of tasks.
    tasks = max(1, chunks.count())
    everything = runs.union(_repeated_windows(found, folder, text, limit, tasks)).union(chunks)
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    types = [to_arrow_type(f.dataType) for f in fields]

    def cut(t: pa.Table) -> pa.Table:
        batch = _chunk(folder, t.column("chunk")[0].as_py())
        row, first, last = (t.column(n).to_numpy() for n in ("row", "first", "last"))
        row, first, last = _joined(row, first, last)
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
        out = []
        for i, content in enumerate(raw(batch.column(text))):
            s, e = bounds[i], bounds[i + 1]
            gone = kept_parts(content, first[s:e], last[s:e])
            counts = (len(content), sum(b - a for a, b in gone), len(gone))
            if outputs == "text":
                whole = [(_whole(content, a, 1), _whole(content, b, -1)) for a, b in gone]
                edges = [0, *(x for p in whole for x in p), len(content)]
                kept = b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b)
                out.append((*counts, kept.decode(), [{"start": a, "end": b} for a, b in gone]))
            else:
                edges = [0, *(x for p in gone for x in p), len(content)]
                kept = b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((*counts, hashlib.sha256(kept).hexdigest()))
        new = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), types, strict=True)]
        return pa.Table.from_arrays([batch.column(c) for c in keep] + new, names=[f.name for f in schema])

    return everything.repartition(tasks, "chunk").groupBy("chunk").applyInArrow(cut, schema)
