"""Tokens of a batch of texts inside an Arrow pass, by the rules of `functions.text`.

Works on the bytes of the whole batch at once: where words begin, where lines do, and which lines begin with
an empty token. Word bytes that are left when all others go are the tokens laid end to end, so they
become an Arrow array without a copy per token. Empty ones come last, so tokens are in no order unless that is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Word characters are ASCII letters and digits, underscore and apostrophe.
_WORD = np.array([chr(b).isalnum() and b < 128 or chr(b) in "_'" for b in range(256)])
_LF, _CR = 10, 13

# The arrays of a pass are some fifty times as large as the texts they are made of, so a batch goes through it in slices of so many bytes.
SLICE_BYTES = 1 << 20


@dataclass
class Tokens:
    """Tokens of all rows, the row and the line (over the batch) of each, and how many lines there are from there to the last one of its row."""

    tokens: pa.Array
    row: np.ndarray
    line: np.ndarray | None = None
    lines_left: np.ndarray | None = None


def _places(rows: pa.Array) -> np.ndarray:
    """Where each text or list begins in what lies below, and where the last one ends: a view."""
    if not len(rows):
        return np.zeros(1, np.int64)
    wide = pa.types.is_large_string(rows.type) or pa.types.is_large_list(rows.type)
    return np.frombuffer(rows.buffers()[1], np.int64 if wide else np.int32)[rows.offset : rows.offset + len(rows) + 1]


def _running_bytes(rows: pa.Array) -> np.ndarray:
    """Bytes of texts or token arrays up to each row; a token counts a few more."""
    places = _places(rows).astype(np.int64)
    if pa.types.is_list(rows.type) or pa.types.is_large_list(rows.type):
        return _places(rows.values)[places] + 8 * places
    return places


def slice_bounds(rows: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of the rows of each slice, all rows in order. No row is cut: one beyond the limit is a slice of its own."""
    sums, at = _running_bytes(rows), 0
    while at < len(rows):
        to = int(np.searchsorted(sums, sums[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(rows))
        yield at, to - at
        at = to


def sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches bounded by the bytes of that column, however many rows a batch has; nothing is copied."""
    for batch in batches:
        for at, n in slice_bounds(batch.column(column)):
            yield batch.slice(at, n)


def listed_tokens(tokens: pa.Array) -> Tokens:
    """Of rows that are token arrays already."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return Tokens(tokens.flatten(), row, row)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[bounds[0] : bounds[-1]], bounds - bounds[0]


def _lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """-> (row, start, end) of each line; the end is that of its content. Nothing follows a final line end."""
    lf, cr = data == _LF, data == _CR
    behind_cr = np.append(False, cr[:-1])[: len(data)]
    behind_cr[bounds[:-1][bounds[:-1] < len(data)]] = False  # of the text before
    pair = lf & behind_cr  # the second half of a line end
    alone = cr.copy()
    alone[np.flatnonzero(pair) - 1] = False
    ends = np.flatnonzero(lf | alone)
    size = np.diff(bounds)
    rows = np.arange(len(size))
    # A line begins with each text, and behind each line end that is not the last byte of its text.
    row_of_end = np.searchsorted(bounds, ends, "right") - 1
    inner = ends + 1 < bounds[row_of_end + 1]
    starts = np.concatenate([bounds[:-1][size > 0], ends[inner] + 1])
    row = np.concatenate([rows[size > 0], row_of_end[inner]])
    order = np.argsort(starts, kind="stable")
    starts, row = starts[order], row[order]
    # It ends at the next line end, or with its text where there is none.
    at = np.searchsorted(ends, starts)
    stop = bounds[row + 1].copy()
    has = at < len(ends)
    has[has] = ends[at[has]] < stop[has]
    content = ends - pair[ends] if len(ends) else ends
    stop[has] = content[at[has]]
    return row, starts, stop


def text_tokens(texts: pa.Array, as_lines: bool = False, weights: bool = False, in_order: bool = False) -> Tokens:
    """Of texts, or, `as_lines`, of rows that are one line each; with `weights` also the lines left."""
    data, bounds = _bytes(texts)
    word = _WORD[data]
    before = np.append(False, word[:-1])
    inner = bounds[1:-1]
    before[inner[inner < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    if as_lines:
        row, first, stop = np.arange(len(texts)), bounds[:-1], bounds[1:]
    else:
        row, first, stop = _lines(data, bounds)
    line_of_word = np.searchsorted(first, starts, "right") - 1
    if as_lines and len(starts):
        # Empty rows share their start with the row behind them.
        line_of_word = np.searchsorted(bounds, starts, "right") - 1
    words_in = np.bincount(line_of_word, minlength=len(first)) if len(first) else np.zeros(0, np.int64)
    empty = stop == first
    opens = np.zeros(len(first), bool)
    opens[~empty] = ~word[first[~empty]]
    bare = np.flatnonzero(empty | opens & (words_in > 0))

    after = np.append(word[1:], False)
    after[inner[inner > 0] - 1] = False
    lengths = np.flatnonzero(word & ~after) + 1 - starts
    offsets = np.concatenate([[0], np.cumsum(lengths), np.full(len(bare), lengths.sum())]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[word]))]
    tokens = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)
    line = np.concatenate([line_of_word, bare]).astype(np.int64)
    left = None
    if weights:
        n_lines = np.bincount(row, minlength=len(texts))
        number = np.arange(len(row)) - np.repeat(np.cumsum(n_lines) - n_lines, n_lines)
        left = (n_lines[row] - number)[line]
    row = row[line] if len(row) else np.zeros(0, np.int64)
    if in_order:
        # An empty token is the only one of its line, or stands before all others.
        order = np.lexsort((np.append(np.ones(len(starts)), np.zeros(len(bare))), line))
        tokens, row, line, left = tokens.take(pa.array(order)), row[order], line[order], left if left is None else left[order]
    return Tokens(tokens, row, line, left)
