"""A minimal perfect hash over 128-bit keys, in flat numpy arrays.

Keys are dealt into a bit table a little larger than their number; those that
fall alone into a bit keep it, the others go on to a smaller table, until none
is left. A key's slot is the number of set bits before its own, so n keys have
the slots 0 to n-1. Every slot stores its key, so a foreign key is found out.
"""

from __future__ import annotations

import numpy as np

SPARE = 1.5  # bits a key in each table
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _placed(a: np.ndarray, b: np.ndarray, round_: int, size: int) -> np.ndarray:
    x = a ^ (b * _MIX[0] + _MIX[1:2] * np.uint64(2 * round_ + 1))
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots of distinct keys (a, b), each a pair of uint64."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.tables: list[tuple[int, np.ndarray, np.ndarray]] = []  # first slot, bits, rank of each bit
        left, first = np.arange(len(a)), 0
        while len(left):
            size = int(SPARE * len(left)) + 1
            at = _placed(a[left], b[left], len(self.tables), size)
            alone = np.bincount(at, minlength=size) == 1
            if len(self.tables) > 200:
                raise ValueError("keys are not distinct")
            self.tables.append((first, alone, np.cumsum(alone) - 1))
            first += int(alone.sum())
            left = left[~alone[at]]
        self.a, self.b = np.empty(len(a), np.uint64), np.empty(len(a), np.uint64)
        own = self._find(a, b)
        self.a[own], self.b[own] = a, b

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for k, (first, bits, rank) in enumerate(self.tables):
            at = _placed(a[left], b[left], k, len(bits))
            hit = bits[at]
            slot[left[hit]] = first + rank[at[hit]]
            left = left[~hit]
        return slot

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for a key that is not in the table."""
        slot = self._find(a, b)
        known = slot >= 0
        known[known] = (self.a[slot[known]] == a[known]) & (self.b[slot[known]] == b[known])
        return np.where(known, slot, -1)
