"""Tables of sampled bits: where two bit strings that differ in few bits meet for a stated probability.

A table samples ``key_bits`` of the ``width`` bits as its key. Two strings whose bits differ with probability ``differ``
meet in a table if they agree in all of them; there are as many tables as make a meeting in one of them, within ``budget``
differing bits, as likely as ``recall``. The longer the key, the fewer strings share it and the more tables it takes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np


def mixed(x: np.ndarray) -> np.ndarray:
    """x (uint64) with every bit dependent on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Tables:
    width: int
    differ: float
    recall: float
    budget: int

    def found(self, key_bits: int, tables: int) -> float:
        """Probability that a pair meets in a table and is within the budget."""
        total = 0.0
        for d in range(self.budget + 1):
            share = math.comb(self.width, d) * self.differ**d * (1 - self.differ) ** (self.width - d)
            total += share * (1 - (1 - self.meeting(d, key_bits)) ** tables)
        return total

    def meeting(self, d: int, key_bits: int) -> float:
        """Probability that strings with d differing bits share a key."""
        return math.comb(self.width - d, key_bits) / math.comb(self.width, key_bits)

    @cache  # noqa: B019
    def sampled(self, key_bits: int) -> np.ndarray:
        """The bits of each table: rows of key_bits positions."""
        tables = 1
        while key_bits and self.found(key_bits, tables) < self.recall:
            tables += 1 + tables // 20
        rng = np.random.default_rng(key_bits)
        return np.stack([rng.permutation(self.width)[:key_bits] for _ in range(tables)])

    def keys(self, bits: np.ndarray, key_bits: int, salt: np.ndarray) -> np.ndarray:
        """Keys (rows by tables, int64) of rows of bits (uint8): hashes of the table, its bits and the row's salt (uint64)."""
        sampled = self.sampled(key_bits)
        values = np.stack([bits[:, at].astype(np.uint64) @ (np.uint64(1) << np.arange(len(at), dtype=np.uint64)) for at in sampled], 1)
        numbered = mixed(values + (np.arange(len(sampled), dtype=np.uint64) << np.uint64(44)))
        return mixed(numbered + mixed(salt)[:, None]).view(np.int64)


def bits_of(words: np.ndarray) -> np.ndarray:
    """Bits (uint8) of rows of 64-bit words."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little")
