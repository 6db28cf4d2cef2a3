"""Conversation repair against an exhaustive search and a plain program over whole conversations."""

import hashlib
import random
import re
from heapq import heappop, heappush

import pytest
from articleflow.llm import dialogue
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit array<int>"


def cheapest(turns):
    """(cost, letters, roles) by uniform-cost search over whole edit strings, least string first."""
    goal = len(turns)
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, roles, out = heappop(heap)
        if (at, roles[-1:], roles[:1] == "s" and len(roles) == 1, not roles) in seen:
            continue
        seen.add((at, roles[-1:], roles[:1] == "s" and len(roles) == 1, not roles))
        if at == goal and re.fullmatch("(s?(ua)+)?", roles):
            return cost, letters, out
        due = "a" if roles[-1:] == "u" else "u"
        heappush(heap, (cost + 2, letters + "I", at, roles + due, (*out, (due, None))))
        if at < goal:
            initial, goes, late = turns[at]
            heappush(heap, (cost + 3, letters + "D", at + 1, roles, out))
            if not goes:
                heappush(heap, (cost + 2 + late, letters + "R", at + 1, roles + due, (*out, (due, at))))
                if initial == due or (initial == "s" and not roles):
                    heappush(heap, (cost + late, letters + "K", at + 1, roles + initial, (*out, (initial, at))))


def plain(rows):
    """The contract's columns for each conversation, row by row."""
    out = {}
    for c in {r[0] for r in rows}:
        said = [(r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows if r[0] == c]
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, turns, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in said:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            turns.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        numbers = [t for t, _, _ in said if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, letters, made = cheapest(turns)
        names = {"u": "user", "a": "assistant"}
        lines, kept = [], iter(x for x in letters if x != "D")
        for (due, at), letter in zip(made, kept, strict=True):
            lines.append(f"{said[at][1] if letter == 'K' else names[due]}:{'' if at is None else said[at][2]}")
        out[c] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def awkward(n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "ux"])
            rows.append((c, rng.choice([t, t, t, None, 2 * t]), role, rng.choice(["yes.", "no", " \t\n", "", "why? ", "so!\n", f"line {t}.", f"cut {t}"])))
    rows += [(None, None, None, None), (None, 3, "user", "x."), (None, 3, "user", "x.")]
    rows += [(100, 0, None, "a."), (100, 1, "user", None), (101, None, "user", "a."), (101, None, "user", "a."), (102, 5, "user", "w " * 50_000)]
    return rows


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("block", [4096, 2])
def test_repair(spark, monkeypatch, block):
    monkeypatch.setattr(dialogue, "BLOCK", block)
    rows = awkward()
    want = plain(rows)
    df = spark.createDataFrame([(*r, "clash", [1]) for r in rows], SCHEMA).repartition(3)
    ids = spark.createDataFrame([(r[0],) for r in rows] + [(999,), (999,)], "conv_id long")
    got = dialogue.repair(df, ids).collect()
    assert len(got) == len(want) + 1
    for r in got:
        expected = want.get(r.conv_id) if r.conv_id != 999 else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        assert tuple(r[c] for c in COLUMNS) == expected, r.conv_id
    turns = dialogue.repair(df, outputs="turns").collect()
    for c in want:
        lines = [f"{t.role}:{t.text}" for t in sorted((t for t in turns if t.conv_id == c), key=lambda t: t.place)]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want[c][-1]
    assert dialogue.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    """A conversation that is most of the table is cut into blocks, none above the limit."""
    monkeypatch.setattr(dialogue, "BLOCK", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = []
    cut = dialogue.edits
    monkeypatch.setattr(dialogue, "edits", lambda blocks: (sizes.extend((r.part, r.n) for r in blocks.select("part", F.length("turns").alias("n")).collect()), cut(blocks))[1])
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"a{t}.", f"b{t}", ""])) for t in range(3000)] + [(2, 0, "user", "same.")] * 500
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    try:
        got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in dialogue.repair(df).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain(rows)
    assert max(n for _, n in sizes) <= 64 and len({p for p, _ in sizes}) > 1


def test_walks_from_every_state():
    rng = random.Random(7)
    for _ in range(300):
        turns = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11]) for _ in range(rng.randint(0, 8)))
        as_read = [("-sua"[t & 3], t >= 8, int(bool(t & 4))) for t in turns]
        letters, state, spent = dialogue.walk(turns, dialogue.END, 0, True)
        cost, best, _ = cheapest(as_read)
        assert (spent, letters) == (cost, best) and state in (0, 3)
        assert dialogue.vector_before(turns, dialogue.END)[0] == cost


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "a. b? c!") for c in (*range(40), None) for t in (*range(5), None)]
    got = dialogue.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fate == 4 else role, "" if fate == 1 else "a b c" if fate == 2 else text)
        want += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
