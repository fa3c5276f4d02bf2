"""A compressed FM-index over a sequence of integers: wavelet matrix, rank by popcount, backward search."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; the last symbol has to be the only one of its kind and the smallest."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.append(0, text[order][1:] != text[order][:-1]))
    width = 1
    while rank[order[-1]] < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
        width *= 2
    return order


class _Bits:
    """A bit vector in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words).astype(np.int64)))[:-1]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        at = i >> 6
        mask = ~(_FULL << (i & 63).astype(np.uint64))
        return self.before[at] + np.bitwise_count(self.words[at] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, size: int):
        self.levels: list[tuple[int, int, _Bits]] = []
        for level in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> level) & 1
            zeros = int(len(bits) - bits.sum())
            self.levels.append((level, zeros, _Bits(bits)))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.starts = self.walk(np.arange(size), np.zeros(size, np.int64))

    def walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, zeros, bits in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> level) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first i."""
        return self.walk(symbol, i) - self.starts[symbol]


class FMIndex:
    """The suffix array is kept only if nothing stands at the places; otherwise it puts `marks` in order and is dropped."""

    def __init__(self, text: np.ndarray, size: int, marks: np.ndarray | None = None):
        suffixes = suffix_array(text)
        self.suffixes, self.marks = (suffixes, None) if marks is None else (None, marks[suffixes])
        self.transform = WaveletMatrix(text[suffixes - 1], size)
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=size)))

    def intervals(self, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of many patterns of one length at once: patterns[j][i] is symbol j of pattern i.

        -> the interval of suffixes [from, to) that begin with each.
        """
        last = patterns[-1]
        start, stop = self.before[last], self.before[last + 1]
        for symbol in reversed(patterns[:-1]):
            start = self.before[symbol] + self.transform.rank(symbol, start)
            stop = self.before[symbol] + self.transform.rank(symbol, stop)
        return start, stop


def range_minima(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Smallest value in each non-empty range.

    Every different range is read once: intervals of patterns of one length are equal or apart, so that takes no
    more than the values, and no table.
    """
    if not len(start):
        return np.empty(0, values.dtype)
    width = len(values) + 1
    ranges, which = np.unique(start * width + stop, return_inverse=True)
    bounds = np.stack([ranges // width, ranges % width], axis=1).ravel()
    return np.minimum.reduceat(np.append(values, values[-1:]), bounds)[::2][which]
