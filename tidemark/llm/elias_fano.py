"""Elias-Fano sequences over mapped memory, read and searched in bulk.

A rising sequence of n numbers below u keeps the low log2(u / n) bits of each number packed, and the high
bits in unary: about 2 + log2(u / n) bits a number. A directory of the zeros before each word of the
unary part makes random access and successor search a few array steps, for many queries at once.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_ONE, _SIX, _LAST = U(1), U(6), U(63)
_BLOCK = 1 << 17  # numbers packed at a time


def _table() -> np.ndarray:
    """Position of each set bit of each byte."""
    table = np.zeros((256, 8), np.uint8)
    for byte in range(256):
        places = [i for i in range(8) if byte >> i & 1]
        table[byte, : len(places)] = places
    return table.ravel()


_PLACES = _table()
_1, _2, _4, _8, _56 = (U(i) for i in (1, 2, 4, 8, 56))
_5S, _3S, _FS, _ONES, _TOPS = U(0x5555555555555555), U(0x3333333333333333), U(0x0F0F0F0F0F0F0F0F), U(0x0101010101010101), U(0x8080808080808080)


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit number ``rank`` (from 0, one that exists) in each 64-bit word."""
    rank = rank.astype(U)
    sums = words - ((words >> _1) & _5S)
    sums = (sums & _3S) + ((sums >> _2) & _3S)
    sums = ((sums + (sums >> _4)) & _FS) * _ONES  # in each byte the set bits up to it
    byte = np.bitwise_count((((rank * _ONES) | _TOPS) - sums) & _TOPS).astype(U)
    shift = np.minimum(byte, U(7)) * _8
    rank = rank - (((sums << _8) >> shift) & U(0xFF))
    return (shift + _PLACES[((((words >> shift) & U(0xFF)) << U(3)) | rank) & U(2047)]).astype(np.int64)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` of each value, one after the other, and a spare word at least."""
    out = np.zeros(-(-len(values) * bits // 64) + 2, U)
    if not bits:
        return out
    for i in range(0, len(values), _BLOCK):  # of 64 values a multiple, so that a block begins a word
        own = values[i : i + _BLOCK] & U((1 << bits) - 1)
        at = np.arange(i, i + len(own), dtype=np.int64) * bits
        word, off = at >> 6, (at & 63).astype(U)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] += np.add.reduceat(own << off, first)
        over = np.flatnonzero(off + U(bits) > U(64))
        out[word[over] + 1] += own[over] >> (U(64) - off[over])
    return out


def build(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """The arrays of a sequence of rising (not strictly) unsigned numbers below ``universe``."""
    n = len(values)
    low_bits = max(0, (int(universe) // max(n, 1)).bit_length() - 1)
    high = (values >> U(low_bits)).astype(np.int64)
    low = _packed(values.astype(U), low_bits).astype("<u8")
    length = n + (int(high[-1]) if n else 0) + 1
    unary = np.zeros(-(-length // 64) * 64, np.uint8)
    unary[high + np.arange(n)] = 1
    words = np.packbits(unary, bitorder="little").view("<u8")
    zeros = np.zeros(len(words) + 1, "<i8")
    np.cumsum(64 - np.bitwise_count(words).astype(np.int64), out=zeros[1:])
    return {"size": np.array([n, low_bits], "<i8"), "low": low, "high": words, "zeros": zeros}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, bits = map(int, arrays["size"])
        self._bits, self._mask = U(bits), U((1 << bits) - 1)
        self._low, self._high, self._zeros = arrays["low"], arrays["high"], arrays["zeros"]
        self._ones = None

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(U) * self._bits
        word, off = (at >> _SIX).astype(np.int64), at & _LAST
        spill = np.where(off > 0, self._low[word + 1] << ((U(64) - off) & _LAST), U(0))
        return ((self._low[word] >> off) | spill) & self._mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        if self._ones is None:
            self._ones = 64 * np.arange(len(self._zeros), dtype=np.int64) - self._zeros
        word = np.searchsorted(self._ones, i, side="right") - 1
        at = 64 * word + _select(self._high[word], i - self._ones[word])
        return ((at - i).astype(U) << self._bits) | self._low_of(i)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of zero number ``k`` of the unary part; its length beyond the last."""
        word = np.minimum(np.searchsorted(self._zeros, k, side="right") - 1, len(self._high) - 1)
        return 64 * word + _select(~self._high[word], k - self._zeros[word])

    def _run_of(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and end of the numbers with these high bits."""
        before = self._zero(np.maximum(high - 1, 0))
        word = before >> 6
        rest = (~self._high[word] >> (before & 63).astype(U)) >> _1  # the zeros after that one in its word
        gap = np.bitwise_count((rest & (~rest + _1)) - _1).astype(np.int64)
        end = np.where(high > 0, before + 1 + gap, before)
        other = np.flatnonzero((rest == 0) & (high > 0))
        if len(other):
            end[other] = self._zero(high[other])
        return np.where(high > 0, before + 1 - high, 0), np.minimum(end - high, self.n)

    def _search(self, x: np.ndarray, first: np.ndarray | None, last: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The first place whose number is at least x, and the end of those with its high bits, between ``first`` and ``last``."""
        start, stop = self._run_of(np.minimum((x >> self._bits).astype(np.int64), int(self._zeros[-1]) - 1))
        if first is not None:
            start, stop = np.maximum(start, first), np.minimum(stop, last)
            start = np.minimum(start, last)
        end = stop.copy()
        wanted = x & self._mask
        open_ = np.flatnonzero(start < stop)
        while len(open_):
            middle = (start[open_] + stop[open_]) >> 1
            less = self._low_of(middle) < wanted[open_]
            start[open_] = np.where(less, middle + 1, start[open_])
            stop[open_] = np.where(less, stop[open_], middle)
            open_ = open_[start[open_] < stop[open_]]
        return start, end

    def successor(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """The first place whose number is at least x, between ``first`` and ``last`` where given."""
        if not self.n:
            return np.zeros(len(x), np.int64)
        return self._search(x, first, last)[0]

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """The place of x, -1 where the sequence (between ``first`` and ``last``) lacks it. Rising x are found fastest."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at, end = self._search(x, first, last)
        inside = (at < end) & ((x >> self._bits) < U(int(self._zeros[-1])))
        ok = self._low_of(np.where(inside, at, 0)) == (x & self._mask)
        return np.where(inside & ok, at, -1)
