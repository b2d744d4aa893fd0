"""Words and hashed shingle sets of texts, vectorised for Python tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """Maximal runs of bytes that are no white space (blank, 0x09 to 0x0D)."""
    return text.split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: one-to-one, every output bit depends on every input bit."""
    shift = np.uint64(33)
    x = (x ^ (x >> shift)) * _MIX[0]
    x = (x ^ (x >> shift)) * _MIX[1]
    return x ^ (x >> shift)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    n = len(hashes) - size + 1
    out = mix(hashes[:n] + _STEP)
    for k in range(1, size):
        out = mix(out * np.uint64(3) + hashes[k : k + n])
    return out


def shingles(tokens: list[bytes], size: int) -> np.ndarray:
    """The sorted set of hashed ``size``-word shingles; fewer words make one shingle, none make none."""
    if not tokens:
        return np.empty(0, np.uint64)
    return np.unique(windows(word_hashes(tokens), min(size, len(tokens))) ^ np.uint64(len(tokens) < size))
