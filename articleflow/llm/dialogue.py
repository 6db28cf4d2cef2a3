"""Conversation structure repair by a square-root checkpointed dynamic program.

A repaired conversation is empty, or has an optional system turn and then pairs of a user and
an assistant turn. A turn is kept (0), given the role that is due (2) or deleted (3); an empty turn
of the role that is due may be inserted anywhere (2). A blank or duplicate turn must go, and a
truncated one that stays adds 1. Of the cheapest edits the ASCII-least string of their initials
(D, I, K, R) is taken.

Backward vectors hold, for each state of the roles so far, the least cost to come. Turns, as one
byte each, are range-partitioned in order and cut into blocks, so it doesn't matter whether
a conversation has two turns or a third of all rows. Vectors are kept at block ends only: a
conversation of several blocks composes their cost matrices from the back, each block is walked
from every state it may be entered in, and the walks that fit together are chosen from the front.
Inside a block, vectors are kept at every square root of its turns and recomputed between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from articleflow.session import settle

INSERT, REROLE, DELETE, CUT_SHORT = 2, 2, 3, 1
# States: no turn yet, after a system, a user, an assistant turn. The state an inserted turn leads to.
NEXT = (2, 2, 3, 2)
DUE = {2: "user", 3: "assistant"}
INITIALS = {"s": 1, "u": 2, "a": 3}
# Where a kept turn leads: (state, kind of its role) to state.
KEEPS = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}
# Costs to come after the last turn, with inserts.
END = (0, 4, 2, 0)
FAR = 1 << 50
# Turns of a block.
BLOCK = 4096
# A turn as a byte: kind of its role, plus 4 if truncated, or 8 if it must go.
LATE, GOES = 4, 8
BLANKS = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def costs_before(turn: int, after: Vector) -> Vector:
    """Least costs to come before a turn, from those after it."""
    a0, a1, a2, a3 = after
    w0, w1, w2, w3 = a0 + DELETE, a1 + DELETE, a2 + DELETE, a3 + DELETE
    if turn < GOES:
        late, kind = (CUT_SHORT if turn & LATE else 0), turn & 3
        user, answer = late + a2 + (0 if kind == 2 else REROLE), late + a3 + (0 if kind == 3 else REROLE)
        w0 = min(w0, user, late + a1) if kind == 1 else min(w0, user)
        w1, w2, w3 = min(w1, user), min(w2, answer), min(w3, user)
    v2, v3 = min(w2, w3 + INSERT), min(w3, w2 + INSERT)
    return min(w0, v2 + INSERT), min(w1, v2 + INSERT), v2, v3


def vector_before(turns: bytes, after: Vector) -> Vector:
    for turn in reversed(turns):
        after = costs_before(turn, after)
    return after


def walk(turns: bytes, after: Vector, state: int, last: bool) -> tuple[str, int, int]:
    """Initials of the cheapest edits from ``state`` on, the state after them, and their cost.

    ``after`` are the costs to come behind these turns; after the ``last`` turns of a conversation, turns
    that are due are inserted. Vectors are kept at every square root of the turns.
    """
    n = len(turns)
    step = isqrt(n) + 1
    marks = {n: after}
    for end in range((n - 1) // step * step, -1, -step):
        marks[end] = vector_before(turns[end : end + step], marks[min(end + step, n)])
    letters: list[str] = []
    spent = 0
    for start in range(0, n, step):
        end = min(start + step, n)
        inner = [marks[end]]
        for turn in reversed(turns[start:end]):
            inner.append(costs_before(turn, inner[-1]))
        inner.reverse()
        for at in range(start, end):
            turn, now, then = turns[at], inner[at - start], inner[at - start + 1]
            if now[state] != then[state] + DELETE and now[state] == now[NEXT[state]] + INSERT:
                letters.append("I")
                state = NEXT[state]
                spent += INSERT
                if now[state] != then[state] + DELETE and now[state] == now[NEXT[state]] + INSERT:
                    letters.append("I")
                    state = NEXT[state]
                    spent += INSERT
            late = CUT_SHORT if turn & LATE else 0
            kept = KEEPS.get((state, turn & 3)) if turn < GOES else None
            if now[state] == then[state] + DELETE:
                letters.append("D")
                spent += DELETE
            elif kept is not None and now[state] == then[kept] + late:
                letters.append("K")
                state = kept
                spent += late
            else:
                letters.append("R")
                state = NEXT[state]
                spent += REROLE + late
    while last and state in (1, 2):
        letters.append("I")
        state = NEXT[state]
        spent += INSERT
    return "".join(letters), state, spent


def _cut(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows (conv, turn, copies) to blocks (conv, part, number, turns) of at most ``size`` turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        conv, held = None, bytearray()
        done: list[tuple] = []

        def close() -> None:
            nonlocal number
            done.append((conv, part, number, bytes(held)))
            number += 1
            held.clear()

        def taken() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=["conv", "part", "number", "turns"])

        for batch in batches:
            for c, turn, copies in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and c != conv:
                    close()
                conv = c
                held.append(turn)
                rest = copies - 1
                while rest or len(held) >= size:
                    more = min(rest, size - len(held))
                    held.extend(bytes([turn & 3 | GOES]) * more)
                    rest -= more
                    if len(held) >= size:
                        close()
                    if len(done) >= size:
                        yield taken()
            if done:
                yield taken()
        if held:
            close()
            yield taken()

    return run


def _arrow(fields: str, inputs: list[str], work: Callable[..., list[list]]) -> Callable[[DataFrame], DataFrame]:
    """Rows whose columns ``work`` makes from the values of ``inputs``, a batch at a time."""
    schema = T.StructType.fromDDL(fields)
    kind = to_arrow_schema(schema)

    def of(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = work(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, kind, strict=True)], schema=kind)

        return df.select(*inputs).mapInArrow(run, schema)

    return of


def _solve(conv: list, part: list, number: list, turns: list) -> list[list]:
    got = [walk(t, END, 0, True) for t in turns]
    return [conv, part, number, [g[0] for g in got], [g[2] for g in got]]


def _matrices(conv: list, part: list, number: list, turns: list) -> list[list]:
    units = [tuple(0 if s == t else FAR for s in range(4)) for t in range(4)]
    columns = [[vector_before(x, u) for u in units] for x in turns]
    return [conv, part, number, [[column[s] for s in range(4) for column in m] for m in columns]]


def _checkpoints(conv: list, blocks: list) -> list[list]:
    """The costs to come behind each block of a conversation."""
    out: list[list] = [[], [], [], [], []]
    for c, parts in zip(conv, blocks, strict=True):
        after: Vector = END
        for k, b in enumerate(reversed(parts)):
            for column, value in zip(out, (c, b["part"], b["number"], list(after), k == 0), strict=True):
                column.append(value)
            m = b["matrix"]
            after = tuple(min(m[4 * s + t] + after[t] for t in range(4)) for s in range(4))
    return out


def _walks(conv: list, part: list, number: list, turns: list, after: list, last: list) -> list[list]:
    got = [[walk(t, tuple(a), s, e) for s in range(4)] for t, a, e in zip(turns, after, last, strict=True)]
    return [conv, part, number, [[w[0] for w in g] for g in got], [[w[1] for w in g] for g in got], [[w[2] for w in g] for g in got]]


def _entries(conv: list, blocks: list) -> list[list]:
    out: list[list] = [[], [], [], []]
    for c, parts in zip(conv, blocks, strict=True):
        state = 0
        for b in parts:
            for column, value in zip(out, (c, b["part"], b["number"], state), strict=True):
                column.append(value)
            state = b["leaves"][state]
    return out


def edits(blocks: DataFrame) -> DataFrame:
    """Blocks (conv, part, number, turns) to (conv, part, number, letters, cost), the cheapest edits."""
    place = ["conv", "part", "number"]
    many = blocks.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    alone = blocks.join(many, "conv", "left_anti")
    parted = settle(blocks.join(many, "conv", "left_semi"), "parted")

    def gathered(df: DataFrame, value: str) -> DataFrame:
        return df.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "number", value))).alias("blocks"))

    simple = _arrow("conv string, part long, number long, letters string, cost long", [*place, "turns"], _solve)(alone)
    matrices = _arrow("conv string, part long, number long, matrix array<long>", [*place, "turns"], _matrices)(parted)
    points = _arrow("conv string, part long, number long, after array<long>, last boolean", ["conv", "blocks"], _checkpoints)(gathered(matrices, "matrix"))
    ways = "conv string, part long, number long, letters array<string>, leaves array<int>, costs array<long>"
    walks = settle(_arrow(ways, [*place, "turns", "after", "last"], _walks)(parted.join(points, place)), "walks")
    entries = _arrow("conv string, part long, number long, state int", ["conv", "blocks"], _entries)(gathered(walks, "leaves"))
    chosen = walks.join(entries, place).select(*place, F.get("letters", F.col("state")).alias("letters"), F.get("costs", F.col("state")).alias("cost"))
    return simple.unionByName(chosen)


def _faults(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with the number of their copies and their faults; what is written once."""
    said = df.select(
        F.col(conv).alias("id"), F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.lit("")).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    counted = said.groupBy("id", "conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return counted.withColumns({"digest": digest, "blank": end == "", "late": (end != "") & ~end.isin(".", "!", "?")})


def _pairs(before: str, initial: str) -> bool:
    return before + initial in ("su", "ua", "au")


def _replay(make: Callable[[], object]) -> Callable:
    """Rows of whole conversations, each led by its audit row, through one collector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collector = make()
        for batch in batches:
            names = batch.schema.names
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                collector.add(dict(zip(names, row, strict=True)))
            if (done := collector.take()) is not None:
                yield done
        collector.close()
        if (done := collector.take()) is not None:
            yield done

    return run


class _Turns:
    """The turns of the repaired conversations."""

    NAMES = ["id", "place", "edit", "role", "text"]

    def __init__(self, id_type: pa.DataType):
        self.types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
        self.rows: list[tuple] = []
        self.head: dict | None = None

    def add(self, row: dict) -> None:
        if row["kind"] == 0:
            self.close()
            self.head, self.audit, self.at, self.place, self.state, self.before, self.illegal = row, row["audit"], 0, 0, 0, None, 0
            self.open()
            return
        initial = row["role"][:1]
        if self.before is not None and not _pairs(self.before, initial):
            self.illegal += 1
        if not _pairs(initial, initial):
            self.illegal += row["copies"] - 1
        self.before = initial
        for _ in range(row["copies"]):
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = INITIALS[initial]
                self.turn("K", row["role"], row["text"])
            elif letter == "R":
                self.state = NEXT[self.state]
                self.turn("R", DUE[self.state], row["text"])

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            self.turn("I", DUE[self.state], "")

    def open(self) -> None:
        pass

    def turn(self, edit: str, role: str, text: str) -> None:
        self.rows.append((self.head["id"], self.place, edit, role, text))
        self.place += 1

    def end(self) -> None:
        pass

    def close(self) -> None:
        if self.head is not None:
            self.inserts()
            self.end()
            self.head = None

    def take(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        columns = [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), self.types, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, names=self.NAMES)


class _Digests(_Turns):
    """One row for each conversation; texts go into the digest one after another."""

    FACTS = ["gaps", "blank", "duplicate", "truncated"]
    NAMES = ["id", *FACTS, "illegal", "cost", "audit", "repaired_sha256"]

    def __init__(self, id_type: pa.DataType):
        super().__init__(id_type)
        self.types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def open(self) -> None:
        self.digest = hashlib.sha256()

    def turn(self, edit: str, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.place == 0 else chr(10)}{role}:{text}".encode())
        self.place += 1

    def end(self) -> None:
        h = self.head
        self.rows.append((h["id"], *(h[c] for c in self.FACTS), self.illegal, h["cost"], h["audit"], self.digest.hexdigest()))


def repair(
    df: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", outputs: str = "digests"
) -> DataFrame:
    """Faults and cheapest repair of each conversation.

    ``outputs="digests"`` gives a row for each conversation: gaps, blank, duplicate, truncated, illegal, cost,
    audit (initials of the edits) and the SHA-256 of the repaired ``role:text`` lines; ``"turns"`` the
    repaired turns themselves (place, edit, role, text).

    Turns go by number, null numbers first; equal numbers go by role, then by a digest of the turn. Null roles and texts
    are one space, so a null text is blank. A null id is a conversation of its own. Repeated rows
    are duplicates; ties between edits go to the ASCII-least string. Conversations of ``ids`` (one column) without
    any row get zeros, an empty audit and the digest of nothing. No rows give no conversations.
    Other columns are dropped, so their names don't matter. Texts may be of any length.

    A digest and an audit are one value for a whole conversation: the last step streams a
    conversation through one task in order, holding its audit (a byte for each edit) only.
    """
    rows = settle(_faults(df, conv, turn, role, text), "turns")
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    firsts = rows.groupBy("conv", "digest").agg(earliest)
    first = F.struct(F.col("turn").isNotNull().alias("known"), "turn") == F.col("first")
    light = rows.drop("text").join(firsts, ["conv", "digest"]).withColumn("seen", ~first)
    kind = F.lit(0)
    for letter, number in INITIALS.items():
        kind = F.when(F.substring("role", 1, 1) == letter, number).otherwise(kind)
    goes = F.col("blank") | F.col("seen")
    code = kind + F.when(goes, GOES).when(F.col("late"), LATE).otherwise(0)
    light = settle(light.select("conv", "turn", "role", "digest", "copies", "blank", "late", "seen", code.cast("int").alias("code")), "codes")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ordered = light.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "code", "copies")
    blocks = settle(ordered.mapInArrow(_cut(BLOCK), "conv string, part long, number long, turns binary"), "blocks")
    found = edits(blocks)
    audits = found.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "number", "letters"))), lambda b: b["letters"]), "").alias("audit"), F.sum("cost").alias("cost")
    )
    no = F.lit(0).cast("long")
    turns = light.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(no)).alias("blank"),
        F.sum(F.when(F.col("blank"), no).when(F.col("seen"), F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & ~F.col("seen") & F.col("late"), 1).otherwise(no)).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), no)
    facts = turns.groupBy("conv").agg(gaps.cast("long").alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    source = (df if ids is None else ids).select(F.col(conv).alias("id")).distinct()
    heads = source.withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("id").cast("string")), F.lit(""))).join(facts, "conv", "left").join(audits, "conv", "left")
    heads = heads.select("id", "conv", *(F.coalesce(F.col(c), no).alias(c) for c in [*_Digests.FACTS, "cost"]), F.coalesce("audit", F.lit("")).alias("audit"), F.lit(0).alias("kind"))
    body = rows.select("id", "conv", "turn", "role", "digest", "text", "copies", F.lit(1).alias("kind"))
    stream = heads.unionByName(body, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "kind", *order[1:])
    collector = _Digests if outputs == "digests" else _Turns
    id_type = to_arrow_type(df.schema[conv].dataType)
    kinds = {"place": T.LongType(), "cost": T.LongType(), "illegal": T.LongType(), **dict.fromkeys(_Digests.FACTS, T.LongType())}
    schema = T.StructType([T.StructField(n, df.schema[conv].dataType if n == "id" else kinds.get(n, T.StringType())) for n in collector.NAMES])
    return stream.mapInArrow(_replay(lambda: collector(id_type)), schema).withColumnRenamed("id", conv)


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conversation, turn, role, text) with planted faults, by the CRC-32 of ``conv:turn`` (a null is
    one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's."""

    def spelt(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spelt(F.col(conv)), F.lit(":"), spelt(F.col(turn))).cast("binary")) % 20
    rows = df.select(F.col(conv), F.col(turn), F.col(role), F.col(text), fate.alias("_fate"))
    said = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace(spelt(F.col(text)), "[.!?]", "")).otherwise(spelt(F.col(text)))
    by = F.when(F.col("_fate") == 4, "user").otherwise(spelt(F.col(role)))
    times = F.when(F.col("_fate") == 0, 0).when(F.col("_fate") == 3, 2).otherwise(1)
    return rows.select(conv, turn, by.alias(role), said.alias(text), F.explode(F.array_repeat(F.lit(0), times))).drop("col")
