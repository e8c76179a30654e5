"""Word shingles of whole texts as sets of 64-bit hashes, and MinHash values of them."""

from __future__ import annotations

import numpy as np
import xxhash

_MEMO = 200_000
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value


_HASHES = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _D
    x = x ^ (x >> np.uint64(29))
    return x * _C


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one run.

    Words are what lies between ASCII white space, A-Z in lower case.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    k = min(words, len(h))
    if not k:
        return h
    run = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        run = mixed(run * _A + h[i : len(h) - k + 1 + i] * _B)
    return np.unique(run)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(b) < len(a):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1) if len(b) else np.zeros(len(a), int)
    return int((b[at] == a).sum()) if len(b) else 0


def set_digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    x = xxhash.xxh3_128_intdigest(values.tobytes())
    return _signed(x & 0xFFFFFFFFFFFFFFFF), _signed(x >> 64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class MinHash:
    """``n`` MinHash values by multiplication with fixed odd numbers."""

    def __init__(self, n: int, seed: int = 47):
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = rng.integers(0, 1 << 63, n, np.uint64)

    def __call__(self, values: np.ndarray, block: int = 8192) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(values), block):
            x = (values[at : at + block, None] ^ self.offsets) * self.factors
            x ^= x >> np.uint64(31)
            np.minimum(least, (x * _B).min(axis=0), out=least)
        return least
