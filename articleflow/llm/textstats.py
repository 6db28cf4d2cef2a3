"""Exact counts of words, symbols, repeated lines and repeated word windows of one text."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_MIX = np.random.default_rng(8).integers(1 << 62, 1 << 63, WINDOW).astype(np.uint64) | np.uint64(1)


def code_points(text: bytes) -> int:
    """Characters of UTF-8 bytes: all bytes but those that continue a character."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside a window of ``size`` words that occurs at least twice in the text.

    Mixed hashes show whether any window can repeat; if so, windows get exact numbers by
    doubling: a window of 2k words is the pair of its halves' numbers.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words):
        return 0
    mixed = np.zeros(n, np.uint64)
    spread = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    for i in range(size):
        mixed += spread[i : i + n] * _MIX[i]
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():
        return 0
    width = 1
    while width < size:
        pair = code[: len(code) - width] * (int(code.max()) + 1) + code[width:]
        code = np.unique(pair, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def counts(text: bytes) -> tuple[list[bytes], int, int, int, int]:
    """Words, their code points, symbols, repeated lines, repeated words."""
    words = text.split()
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return words, code_points(b"".join(words)), symbols, repeated_lines(text), repeated_words(words)
