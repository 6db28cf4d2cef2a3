"""Small tables with the awkward cases, and plain versions of the operators' definitions."""

import random
import re

SPACE = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, score string, n_words string, extra array<int>"


def awkward(n: int = 60, seed: int = 1) -> list[tuple]:
    """Documents with nulls, empty and long texts, repeats, ties and columns with clashing names."""
    rng = random.Random(seed)
    words = {
        "en": "the and of river stone with from this that house water light".split(),
        "de": "der und von fluß stein mit aus dieser haus wasser licht über".split(),
    }
    rows = []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 90))), lang))
    passage = " ".join(rng.choice(words["en"]) for _ in range(80))
    rows += [(100 + i, f"{rng.random()} {passage} {rng.random()}", "en") for i in range(5)]
    rows += [(200, rows[3][1], "en"), (201, rows[3][1], "en"), (201, rows[3][1], "en"), (202, None, "en"), (203, "", None), (204, " \n\t", "de")]
    rows += [(205, "...!?", "en"), (None, "a text without an id", "en"), (None, None, None), (206, "x" * 700, None), (207, "the " * 5000, "en"), (208, "é ß " * 90, None)]
    return [(i, t, la, None if k % 5 == 0 else f"s{k % 3}", "0.5", "clash", [k]) for k, (i, t, la) in enumerate(rows)]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(SPACE, text or "")
