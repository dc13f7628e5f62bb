"""Minimal perfect hashing of 64-bit keys by levels of bit arrays.

Each level sets a bit for every key that is alone in its place; the others go
to the next level (Limasset et al., 2017).  A key's number is the rank of its
bit, so n keys have the numbers 0 to n - 1.  A key that was not there when the
table was built gets any number or -1: callers compare it with the stored key.
"""

from __future__ import annotations

import numpy as np

_U64 = np.uint64
#: Places per key of a level.
GAMMA = 2


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = keys + _U64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return ((h ^ (h >> _U64(31))) % _U64(size)).astype(np.int64)


class PerfectHash:
    """Numbers 0 to n - 1 of n distinct keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels, self.offsets, self.ranks, at = levels, [], [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits, dtype=np.int64) - 1)
            self.offsets.append(at)
            at += int(bits.sum())
        self.size = at

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.asarray(keys, _U64)
        while len(left):
            size = GAMMA * len(left) + 1
            at = _places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left, rest = np.arange(len(keys)), np.asarray(keys, _U64)
        for level, (bits, offset, ranks) in enumerate(zip(self.levels, self.offsets, self.ranks)):
            at = _places(rest, level, len(bits))
            hit = bits[at]
            found[left[hit]] = offset + ranks[at[hit]]
            left, rest = left[~hit], rest[~hit]
        return found

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes, at, levels = np.frombuffer(data, np.int64, n, 8).tolist(), 8 * (n + 1), []
        for size in sizes:
            stop = at + (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data[at:stop], np.uint8), count=size).astype(bool))
            at = stop
        return cls(levels)
