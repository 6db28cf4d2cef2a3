"""Minimal acyclic transducer: sorted words to number sequences in one flat, mappable file.

States with the same continuations are shared. Every edge knows how many words come before
those behind it, so a walk gives the word's number, and the number gives its outputs. Edges stand in a
hash table by state and byte, so a step costs the same however many edges a state has. A text may be
stored for each word beside its outputs.
"""

from __future__ import annotations

import mmap
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
from pyarrow import fs

_HEAD = 6
_SPREAD = 0x9E3779B1


def _slot(key, shift: int):
    return (key * _SPREAD & 0xFFFFFFFF) >> shift


def _table(keys: np.ndarray) -> tuple[int, np.ndarray]:
    """Shift, and the slot of each key in a table at most half full; a key goes to the next free slot."""
    bits = max(4, int(2 * len(keys)).bit_length())
    slots = _slot(keys.astype(np.int64), 32 - bits)
    taken = np.zeros(1 << bits, bool)
    out = np.zeros(len(keys), np.int64)
    left = np.arange(len(keys))
    while len(left):
        at, first = np.unique(slots[left], return_index=True)
        free = ~taken[at]
        winners = left[first[free]]
        taken[at[free]] = True
        out[winners] = slots[winners]
        rest = np.ones(len(left), bool)
        rest[first[free]] = False
        left = left[rest]
        slots[left] = (slots[left] + 1) & ((1 << bits) - 1)
    return 32 - bits, out


def map_shared(path: str) -> memoryview:
    """The file's bytes: mapped if the shared folder is mounted, else read into memory."""
    if urlparse(path).scheme in ("", "file"):
        with Path(urlparse(path).path).open("rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as f:
        return memoryview(f.read())


def compile_words(outputs: dict[bytes, list[int]], texts: dict[bytes, str] | None = None) -> bytes:
    """File content for the given words, and their texts; built word by word in sorted order, each state made
    final and shared as soon as no later word can change it."""
    words = sorted(w for w in outputs if w)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open states along the last word: final, frozen edges
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            done = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], done))

    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in w[common:])
        path[-1][0] = True
        last = w
    close(0)
    root = freeze(path[0])
    reach: list[int] = []  # words behind each state; edges lead to earlier states
    keys, target, skip = [], [], []
    for state, (final, edges) in enumerate(states):
        n = int(final)
        for b, to in edges:
            keys.append(state << 8 | b)
            target.append(to)
            skip.append(n)
            n += reach[to]
        reach.append(n)
    shift, slots = _table(np.array(keys, np.int64))
    size = 1 << (32 - shift)
    table = np.full((3, size), -1, np.int32)
    table[:, slots] = [keys, target, skip] if keys else np.zeros((3, 0))
    flat = [i for w in words for i in outputs[w]]
    ends = np.cumsum([0, *(len(outputs[w]) for w in words)])
    blobs = [(texts or {}).get(w, "").encode() for w in words]
    places = np.cumsum([0, *map(len, blobs)])
    parts = [*table, ends, flat, places, [int(f) for f, _ in states]]
    head = [root, len(states), shift, len(words), len(flat), int(places[-1])]
    return b"".join(np.asarray(p, np.int32).tobytes() for p in [head, *parts]) + b"".join(blobs)


class Transducer:
    def __init__(self, content: memoryview):
        head = content[: 4 * _HEAD].cast("i")
        self.root, states, self.shift, words, flat, _ = head
        size = 1 << (32 - self.shift)
        at = 4 * _HEAD

        def take(n: int) -> memoryview:
            nonlocal at
            at += 4 * n
            return content[at - 4 * n : at].cast("i")

        self.keys, self.target, self.skip = take(size), take(size), take(size)
        self.ends, self.flat, self.places, self.final = take(words + 1), take(flat), take(words + 1), take(states)
        self.texts = content[at:]

    def find(self, word: bytes) -> int:
        """The word's number, -1 if it is not there."""
        state, number = self.root, 0
        keys, target, skip, shift, last = self.keys, self.target, self.skip, self.shift, len(self.keys) - 1
        for b in word:
            key = state << 8 | b
            at = (key * 0x9E3779B1 & 0xFFFFFFFF) >> shift
            while (k := keys[at]) != key:
                if k < 0:
                    return -1
                at = at + 1 & last
            number += skip[at]
            state = target[at]
        return number if word and self.final[state] else -1

    def get(self, word: bytes) -> list[int] | None:
        number = self.find(word)
        return None if number < 0 else list(self.flat[self.ends[number] : self.ends[number + 1]])

    def text(self, number: int) -> str:
        """The text stored for a word's number."""
        return str(self.texts[self.places[number] : self.places[number + 1]], "utf-8")
