"""Words of a batch of texts as numpy arrays: where they stand, and a 64-bit hash of each.

A word is a maximal run of bytes outside space and tab..carriage return, the ASCII white
space. All work is vectorised over the bytes of a slice of an Arrow batch; slices are
bounded by bytes, so memory does not depend on the number of rows in a batch. A single
text is never cut: one that is longer than a slice makes a slice of its own.

Hashes are sums of random byte values times powers of an odd base, modulo 2^64, mixed at
the end. They depend on nothing but the word, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C13 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    return x ^ (x >> U64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# For words without punctuation: every ASCII byte that is no letter or digit.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _TABLES["n"]:
        size = max(n, SLICE_BYTES + (1 << 16))
        _TABLES.update(n=size, up=_powers(_BASE, size), down=_powers(_INVERSE, size))
    return _TABLES["up"][:n], _TABLES["down"][:n]


class Slice:
    """Some consecutive texts: `data` holds their bytes, `bounds` where each begins and ends."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray, lower: bool = False, breaks: np.ndarray = SPACE):
        self.first, self.bounds, self.n = first, bounds, len(bounds) - 1
        self.data = _LOWER[data] if lower else data
        self._sums: np.ndarray | None = None
        solid = ~breaks[self.data]
        before = np.empty(len(data) + 1, bool)  # is what stands before this byte part of the same text's word
        before[0], before[1:] = False, solid
        before[bounds] = False
        after = np.empty(len(data) + 1, bool)
        after[:-1], after[-1] = solid, False
        after[bounds] = False
        self.solid = solid
        self.starts = np.flatnonzero(solid & ~before[:-1])
        self.ends = np.flatnonzero(solid & ~after[1:]) + 1
        self.first_word = np.searchsorted(self.starts, bounds)
        self.n_words = np.diff(self.first_word)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the byte ranges [start, end)."""
        up, down = _power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, U64)
            np.cumsum(_BYTE_VALUES[self.data] * up[:-1], out=self._sums[1:])
        raw = (self._sums[ends] - self._sums[starts]) * down[starts]
        return mixed(raw ^ (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.bounds])


def slices(texts: pa.Array, lower: bool = False, limit: int = SLICE_BYTES, breaks: np.ndarray = SPACE) -> Iterator[Slice]:
    """Slices that cover all texts in order; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.null_count:
        # Null slots have no defined bytes, but Arrow writers leave them empty; make sure.
        texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield Slice(at, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], lower, breaks)
        at = to


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive hashes; runs over text bounds have to be dropped by the caller."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        out *= U64(0xC2B2AE3D27D4EB4F)
        out ^= words[j : len(words) - n + 1 + j]
        out = mixed(out)
    return out


def shingle_starts(words_of_text: np.ndarray, n: int) -> np.ndarray:
    """For words laid end to end: True where n words of the same text begin."""
    total = int(words_of_text.sum())
    ends = np.repeat(np.cumsum(words_of_text), words_of_text)
    return (np.arange(total) + n <= ends)[: max(0, total - n + 1)]
