"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words, kept while the worker lives; starts anew when full."""

    def __init__(self, limit: int = 1 << 17):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits, so that any of them can serve as an order or a bucket."""
    values = (values ^ (values >> np.uint64(29))) * MIX
    return values ^ (values >> np.uint64(32))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` neighbouring words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        out *= BASE
        out += hashes[k : k + n]
    return mixed(out)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    out = values[:n].copy()
    for k in range(1, size):
        np.minimum(out, values[k : k + n], out=out)
    return out
