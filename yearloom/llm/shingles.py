"""Sets of word shingles as sorted 64-bit hashes, and their circulant MinHash signatures."""

from __future__ import annotations

import numpy as np
import xxhash

from yearloom.llm.common import TOKENS

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_digest = xxhash.xxh3_64_digest


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _B
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words of lower-cased text.

    A text of fewer words has one shingle, all of them; without words it has none.
    """
    words = np.frombuffer(b"".join(map(_digest, TOKENS(text.lower()))), np.uint64)
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    found = words[:n] + np.uint64(size)
    for k in range(1, size):
        found = found * _A + words[k : n + k]
        found ^= found >> np.uint64(31)
    return np.unique(_mixed(found))


class Circulant:
    """MinHash with two permutations.

    The first, on the ring of 32-bit numbers, breaks up whatever order shingles have.  The
    second gives all coordinates: for coordinate k it is shifted by k places around the
    ring, and the least image is taken.
    """

    CHUNK = 2048  # shingles permuted at a time

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        self.shifts = (np.arange(bands * rows, dtype=np.uint64) * np.uint64(0x9E3779B1)).astype(np.uint32)

    @staticmethod
    def first(x: np.ndarray) -> np.ndarray:
        low = (x >> np.uint64(32)).astype(np.uint32)
        low = low * np.uint32(0x85EBCA6B)
        return low ^ (low >> np.uint32(15))

    @staticmethod
    def second(x: np.ndarray) -> np.ndarray:
        x = x ^ (x >> np.uint32(16))
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        return x

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.shifts), 0xFFFFFFFF, np.uint32)
        places = self.first(hashes)
        for start in range(0, len(places), self.CHUNK):
            part = places[start : start + self.CHUNK]
            images = self.second(part[None, :] + self.shifts[:, None])
            np.minimum(least, images.min(axis=1), out=least)
        return least

    def keys(self, signature: np.ndarray) -> np.ndarray:
        """One bucket per band, as signed 64-bit numbers that differ between bands."""
        parts = signature.reshape(self.bands, self.rows).astype(np.uint64)
        key = np.arange(1, self.bands + 1, dtype=np.uint64) * _A
        for k in range(self.rows):
            key = _mixed(key + parts[:, k] * _B + np.uint64(k))
        return key.view(np.int64)
