"""Minimal perfect hashing of 64-bit keys with numpy: bit arrays of levels, ranked by popcount."""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
_U = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; different seeds act as independent functions."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + _U((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1_000_003) >> _U(32)).astype(np.uint32)


class PerfectHash:
    """Maps n distinct keys onto 0 to n - 1 in constant time; other keys get -1 or any slot.

    Level ``i`` hashes the keys that collided in all levels before; a bit is set where one key is
    alone. A key's slot is the number of set bits before its own, read from a count per 64-bit word.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels, sizes = keys.astype(np.uint64), [], []
        while len(left):
            if len(levels) == 200:
                raise ValueError("keys are not distinct")
            size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            at = (mix(left, len(levels)) % _U(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(np.concatenate(levels) if levels else np.zeros(0, np.uint64), np.array(sizes, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys).astype(np.uint64)
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes, strict=True)):
            at = (mix(keys[left], level) % _U(size)).astype(np.int64) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & _U(1) == 1
            below = np.bitwise_count(self.words[word] & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[left[hit]] = (self.before[word] + below)[hit]
            left = left[~hit]
        return out
