"""Minimal perfect hashing of 64-bit keys in numpy: cascading bit levels with ranks, and the keys stored by slot."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class PerfectHash:
    """Slots 0 to n - 1 of n distinct keys.

    A level has GAMMA bits per key left; a key that is alone at its bit sets it, the others go on to the next
    level. The slot is the number of set bits before. Any other key also gets some slot or none: `slots` compares
    the stored key (and check), so that only true members get one.
    """

    GAMMA = 2

    def __init__(self, keys: np.ndarray, checks: np.ndarray):
        self.words, self.sizes = [], []
        left = keys
        with np.errstate(over="ignore"):
            while len(left):
                size = max(64, (self.GAMMA * len(left) + 63) // 64 * 64)
                at = self._at(left, len(self.sizes), size)
                alone = np.bincount(at, minlength=size) == 1
                self.words.append(np.packbits(alone, bitorder="little").view("<u8"))
                self.sizes.append(size)
                left = left[~alone[at]]
            self.first = np.cumsum([0, *(s // 64 for s in self.sizes)])
            self.words = np.concatenate(self.words) if self.words else np.empty(0, _U)
            self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.uint32)
            self.keys, self.checks = np.zeros(len(keys), _U), np.zeros(len(keys), _U)
            slot = self._slots(keys)
            self.keys[slot], self.checks[slot] = keys, checks

    def __len__(self) -> int:
        return len(self.keys)

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ (_U(level + 1) * _U(0x9E3779B97F4A7C15))) % _U(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        rows = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(rows):
                break
            at = self._at(keys[rows], level, size)
            word, bit = self.first[level] + (at >> 6), (at & 63).astype(_U)
            value = self.words[word]
            hit = (value >> bit) & _U(1) == 1
            below = np.bitwise_count(value & ((_U(1) << bit) - _U(1)))
            out[rows[hit]] = self.rank[word[hit]].astype(np.int64) + below[hit]
            rows = rows[~hit]
        return out

    def slots(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for those that aren't members."""
        if not len(self):
            return np.full(len(keys), -1, np.int64)
        with np.errstate(over="ignore"):
            out = self._slots(keys)
            return np.where((out >= 0) & (self.keys[out] == keys) & (self.checks[out] == checks), out, -1)
