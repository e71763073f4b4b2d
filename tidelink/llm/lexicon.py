"""A minimal acyclic transducer from words to id sequences, memory-mapped.

Sorted words are compiled state by state, equal suffixes sharing states. Each
arc carries the number of words before it, so the arc outputs along a word
sum to its place among the sorted words, and that place selects its ids.

File layout (little-endian): eight int64 counts, then the int32 arrays
``first`` (states + 1), ``target`` and ``output`` (arcs), ``offset``
(words + 1) and ``ids``, then the bytes ``label`` (arcs) and ``final`` (states).
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable, Sequence

import numpy as np

MAGIC = 0x4C455849
_BYTE = [bytes([b]) for b in range(256)]


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """Serialise the automaton of distinct non-empty words with their ids."""
    items = sorted(entries)
    # a state under construction is [final, {label: state}]; a finished one its number
    finished: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, {}]]  # along the latest word

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs.items()))
            number = finished.get(key)
            if number is None:
                number = finished[key] = len(states)
                states.append(key)
            parent = path[-1][1]
            parent[next(reversed(parent))] = number

    last = b""
    for word, _ in items:
        common = 0
        for a, b in zip(last, word):
            if a != b:
                break
            common += 1
        freeze(common)
        for b in word[common:]:
            path[-1][1][b] = -1
            path.append([False, {}])
        path[-1][0] = True
        last = word
    freeze(0)
    states.append((path[0][0], tuple(path[0][1].items())))

    words_below: list[int] = []  # states are numbered children first
    first, label, target, output = [0], bytearray(), [], []
    for final, arcs in states:
        before = int(final)
        for b, child in arcs:
            label.append(b)
            target.append(child)
            output.append(before)
            before += words_below[child]
        words_below.append(before)
        first.append(len(target))
    ids = [x for _, seq in items for x in seq]
    offset = np.cumsum([0, *(len(seq) for _, seq in items)])
    head = np.array([MAGIC, len(states), len(target), len(items), len(ids), 0, 0, 0], "<i8")
    return b"".join([head.tobytes(), *(np.asarray(x, "<i4").tobytes() for x in (first, target, output, offset, ids)),
                     bytes(label), bytes(final for final, _ in states)])


class Lexicon:
    """Looks words up in a compiled automaton held in a buffer or a mapped file."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        head = view[:64].cast("q")
        if head[0] != MAGIC:
            raise ValueError("not a compiled lexicon")
        n_states, n_arcs, self.n_words, n_ids = head[1:5]
        at = 64
        parts = []
        for n in (n_states + 1, n_arcs, n_arcs, self.n_words + 1, n_ids):
            parts.append(view[at:at + 4 * n].cast("i"))
            at += 4 * n
        self.first, self.target, self.output, self.offset, self.ids = parts
        self.buffer, self.labels = buffer, at
        self.final = view[at + n_arcs:at + n_arcs + n_states]
        self.start = n_states - 1

    @classmethod
    def map_file(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> list[int] | None:
        """The ids of ``word``, or None if the automaton does not accept it."""
        state, place, base = self.start, 0, self.labels
        first, find = self.first, self.buffer.find
        for b in word:
            arc = find(_BYTE[b], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            place += self.output[arc]
            state = self.target[arc]
        if not self.final[state]:
            return None
        return self.ids[self.offset[place]:self.offset[place + 1]].tolist()
