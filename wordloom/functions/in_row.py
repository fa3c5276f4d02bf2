"""Counting inside a row: Arrow UDFs that take a batch of token arrays at once.

Where a row holds all that is counted together, a line or a document, counting there needs no
exchange. The tokens of a slice of a batch are looked up in one pass and counted by row and index. Slices are
bounded by bytes (`batch_tokens.SLICE_BYTES`), so what a pass holds does not grow with the rows of a batch; their counts are
added up before they are given back, as far as `HELD_BYTES` goes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.batch_tokens import Tokens, listed_tokens, slice_bounds, sliced, text_tokens
from wordloom.functions.porter import Stemmer
from wordloom.functions.stop_patterns import delete_literals


# How the rows of a pass give their tokens: `text` is split in the pass, `line` too but is one line, `tokens` are an array.
SPLIT = {
    "text": text_tokens,
    "line": lambda lines: text_tokens(lines, as_lines=True),
    "tokens": listed_tokens,
}


def token_column(rows: DataFrame) -> str:
    return next(c for c in SPLIT if c in rows.columns)


def _splitter(column: str, strip: Sequence[str]):
    """Batch -> Tokens; `strip` are literal patterns to delete first, in that order."""
    strip = list(strip)
    return lambda batch: SPLIT[column](delete_literals(batch.column(column), strip))


def _in_slices(of: Callable[..., pa.Array], rows: pa.Array, *beside: pa.Array) -> pa.Array:
    """`of` the rows, slice by slice, laid end to end."""
    bounds = list(slice_bounds(rows)) or [(0, 0)]
    return pa.concat_arrays([of(*(column.slice(*b) for column in (rows, *beside))) for b in bounds])


class _Lookup:
    """Index of tokens in a list of terms, by their stems where `stem`: distinct tokens are looked up once per batch."""

    def __init__(self, terms: Sequence[str], stem: bool):
        self.terms, self.stemmer = pa.array(terms, pa.string()), Stemmer() if stem else None

    def __call__(self, tokens: pa.Array) -> np.ndarray:
        """Index of each token or -1."""
        words, code = distinct(tokens, self.stemmer)
        return pc.fill_null(pc.index_in(words, value_set=self.terms), -1).to_numpy()[code]


def distinct(tokens: pa.Array, stemmer: Stemmer | None = None) -> tuple[pa.Array, np.ndarray]:
    """-> (the different tokens, or the stems of these; which one each token is)."""
    coded = tokens.dictionary_encode()
    words = coded.dictionary
    words = pa.array(stemmer(words.to_pylist()), pa.string()) if stemmer else words.cast(pa.string())
    return words, coded.indices.to_numpy(zero_copy_only=False)


def term_tally(rows: DataFrame, terms: Broadcast, stem: bool = False, dense: bool = True, running: bool = False) -> Column:
    """How often each term of the list is among the tokens of a row, or among their stems.

    The list comes to the workers by itself, once, not with the rows. Dense: an array as long as the list; otherwise an array
    of (idx, tf) for what occurs. `running` weighs a token by the number of lines from its own to the last one, and so
    does a column `weights` beside the column `tokens`.
    """
    kind = "array<bigint>" if dense else "array<struct<idx: int, tf: bigint>>"
    column = token_column(rows)
    found: list[_Lookup] = []

    def counts(n: int, tokens: Tokens, weights: np.ndarray | None) -> pa.Array:
        if not found:
            found.append(_Lookup(terms.value, stem))
        k = len(terms.value)
        index = found[0](tokens.tokens)
        hit = index >= 0
        at = tokens.row[hit] * k + index[hit]
        if weights is None:
            tally = np.bincount(at, minlength=n * k)
        else:
            # Sums in integers: np.bincount adds weights up as doubles.
            tally = np.zeros(n * k, np.int64)
            np.add.at(tally, at, weights[hit])
        if dense:
            offsets = np.arange(n + 1, dtype=np.int32) * k
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tally, pa.int64()))
        at = np.flatnonzero(tally)
        offsets = np.searchsorted(at, np.arange(n + 1) * k).astype(np.int32)
        hits = pa.StructArray.from_arrays([pa.array((at % max(k, 1)).astype(np.int32)), pa.array(tally[at], pa.int64())], ["idx", "tf"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hits)

    def by_text(rows: pa.Array) -> pa.Array:
        tokens = text_tokens(rows, weights=True) if running else SPLIT[column](rows)
        return counts(len(rows), tokens, tokens.lines_left)

    def by_weight(rows: pa.Array, weights: pa.Array) -> pa.Array:
        return counts(len(rows), SPLIT[column](rows), weights.flatten().to_numpy(zero_copy_only=False))

    @F.arrow_udf(kind)
    def plain(rows: pa.Array) -> pa.Array:
        return _in_slices(by_text, rows)

    @F.arrow_udf(kind)
    def weighted(rows: pa.Array, weights: pa.Array) -> pa.Array:
        return _in_slices(by_weight, rows, weights)

    return weighted(F.col(column), F.col("weights")) if "weights" in rows.columns else plain(F.col(column))


def _counted(split, by_document: bool, stemmer: Stemmer | None):
    """Batch -> (different terms, how often each occurs, or, `by_document`, in how many rows)."""

    def count(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
        tokens = split(batch)
        words, which = distinct(tokens.tokens, stemmer)
        terms = words.dictionary_encode()  # stems of different tokens may be equal
        names, code = terms.dictionary, terms.indices.to_numpy(zero_copy_only=False)[which]
        if by_document:
            code = np.unique(tokens.row.astype(np.int64) * max(len(names), 1) + code) % max(len(names), 1)
        return names, np.bincount(code, minlength=len(names))

    return count


# Counts of slices are held and added up until they take so many bytes.
HELD_BYTES = 8 << 20


def _added_up(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """(*key, n) of slices -> the same, added up by key as far as they may be held."""
    held: list[pa.Table] = []
    size = 0
    for table in tables:
        held.append(table)
        size += table.nbytes
        if size > HELD_BYTES:
            yield from _sums(held)
            held, size = [], 0
    if held:
        yield from _sums(held)


def _sums(tables: list[pa.Table]) -> list[pa.RecordBatch]:
    *keys, n = tables[0].column_names
    added = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(n, "sum")]).rename_columns([*keys, n])
    return added.combine_chunks().to_batches()


def partial_counts(rows: DataFrame, strip: Sequence[str] = ()) -> DataFrame:
    """(text), (line) or (tokens) -> (word, n): how often each token occurs in some of the rows, to be added up."""
    column = token_column(rows)
    count = _counted(_splitter(column, strip), False, None)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in sliced(batches, column):
            words, n = count(batch)
            yield pa.table({"word": words, "n": pa.array(n, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added_up(counts(batches))

    return rows.select(column).mapInArrow(run, "word string, n long")


# A part of a task ends when it has so many different words, or when they take so many bytes.
PART_WORDS = 500_000
PART_BYTES = 16 << 20
PART_ROWS = 65_536


def ranked_parts(rows: DataFrame, by_document: bool = False, stem: bool = False, strip: Sequence[str] = ()) -> DataFrame:
    """Rows -> (part, place, word, n): counts of each part of the corpus, most frequent first, `place` from 0.

    A part is what a task reads, or some of it where that has very many words; nothing is shuffled. With `by_document` n is the number of
    rows that have the word.
    """
    column = token_column(rows)
    split = _splitter(column, strip)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counted(split, by_document, Stemmer() if stem else None)
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def ranked(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.sort_by([("n", "descending"), ("word", "ascending")])
            table = table.append_column("part", pa.array(np.full(len(table), part)))
            table = table.append_column("place", pa.array(np.arange(len(table))))
            yield from table.select(["part", "place", "word", "n"]).combine_chunks().to_batches(PART_ROWS)

        for batch in sliced(batches, column):
            names, n = count(batch)
            held.append(pa.table({"word": names, "n": pa.array(n, pa.int64())}))
            if sum(map(len, held)) > 2 * PART_WORDS or sum(t.nbytes for t in held) > 2 * PART_BYTES:
                held = [merged()]
                if len(held[0]) > PART_WORDS or held[0].nbytes > PART_BYTES:
                    yield from ranked(held.pop())
                    part += 1
        if held:
            yield from ranked(merged())

    return rows.select(column).mapInArrow(run, "part long, place long, word string, n long")


def _pairs(tokens: Tokens, index: np.ndarray, k: int, d: int, directed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """-> (line, first, second) of each co-occurrence within distance d of known tokens on a line, for tokens in their order."""
    found = [np.zeros((3, 0), np.int64)]
    for gap in range(1, d + 1):
        first, second = index[:-gap], index[gap:]
        hit = np.flatnonzero((first >= 0) & (second >= 0) & (tokens.line[:-gap] == tokens.line[gap:]))
        a, b = first[hit].astype(np.int64), second[hit].astype(np.int64)
        if not directed:
            a, b = np.minimum(a, b), np.maximum(a, b)
        found.append(np.stack([tokens.line[hit], a, b]))
    line, a, b = np.concatenate(found, axis=1)
    return line, a, b


def _ordered(column: str, rows: pa.Array) -> Tokens:
    return listed_tokens(rows) if column == "tokens" else text_tokens(rows, as_lines=column == "line", in_order=True)


def partial_pairs(rows: DataFrame, words: Broadcast, d: int, directed: bool) -> DataFrame:
    """(text), (line) or (tokens) -> (i, j, n): how often two words of the list stand within distance d on a line, by their places in the list.

    Counted by slices, to be added up. Not directed: i <= j.
    """
    column = token_column(rows)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        lookup, k = _Lookup(words.value, stem=False), max(len(words.value), 1)
        for batch in sliced(batches, column):
            tokens = _ordered(column, batch.column(column))
            _, a, b = _pairs(tokens, lookup(tokens.tokens), k, d, directed)
            key, n = np.unique(a * k + b, return_counts=True)
            yield pa.table({"i": pa.array((key // k).astype(np.int32)), "j": pa.array((key % k).astype(np.int32)), "n": pa.array(n, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added_up(counts(batches))

    return rows.select(column).mapInArrow(run, "i int, j int, n long")


def pair_tally(tokens: Column, words: Broadcast, d: int, directed: bool) -> Column:
    """Array of (i, j, n), the same for each row, which is a line."""

    def cells_of(lines: pa.Array) -> pa.Array:
        tokens, k = listed_tokens(lines), max(len(words.value), 1)
        row, a, b = _pairs(tokens, _Lookup(words.value, stem=False)(tokens.tokens), k, d, directed)
        key, n = np.unique((row * k + a) * k + b, return_counts=True)
        offsets = np.append(0, np.cumsum(np.bincount(key // (k * k), minlength=len(lines)))).astype(np.int32)
        cells = [pa.array((key // k % k).astype(np.int32)), pa.array((key % k).astype(np.int32)), pa.array(n, pa.int64())]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(cells, ["i", "j", "n"]))

    @F.arrow_udf("array<struct<i: int, j: int, n: bigint>>")
    def tally(lines: pa.Array) -> pa.Array:
        return _in_slices(cells_of, lines)

    return tally(tokens)


def partial_frequencies(rows: DataFrame, stem: bool = False, by_row: bool = True, strip: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text) or (doc_id, whole, line) -> (doc_id, term, df): how many documents have a term, counted inside the task.

    Instead of `text` or `line` there may be an array `tokens`. `by_row`: each row is a document. Otherwise rows that follow each other with one id are one, as lines of a file do; the terms of a document go on from
    batch to batch and are given up at its end. Counts of whole documents have no id, and are to be added up. A document of
    which a task may have a part only (`whole` is false) gives its id with each of its terms, once per part.
    """
    id_type = rows.schema["doc_id"].dataType
    column = token_column(rows)
    split = _splitter(column, strip)

    def counts_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        counted = _counted(split, True, Stemmer() if stem else None)
        for batch in sliced(batches, column):
            names, n = counted(batch)
            yield pa.table({"doc_id": pa.nulls(len(names), batch.schema.field("doc_id").type), "term": names, "df": pa.array(n, pa.int64())})

    def run_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added_up(counts_of_rows(batches))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stemmer = Stemmer() if stem else None
        id_kind = pa.null()
        held: tuple | None = None  # (doc_id, whole, its terms so far)

        def made(ids, terms, counts):
            listed = zip((ids, terms, counts), (id_kind, pa.string(), pa.int64()))
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in listed], ["doc_id", "term", "df"])

        def given_up(doc_id, whole, terms):
            return made([None if whole else doc_id] * len(terms), terms, [1] * len(terms))

        for batch in sliced(batches, column):
            id_kind = batch.schema.field("doc_id").type
            tokens = split(batch)
            words, which = distinct(tokens.tokens, stemmer)
            terms = words.dictionary_encode()  # stems of different tokens may be equal
            names, k = terms.dictionary, max(len(terms.dictionary), 1)
            code = terms.indices.to_numpy(zero_copy_only=False)[which]
            key = batch.column("doc_id").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            begins = np.append(True, key[1:] != key[:-1])
            run_of_row, first = np.cumsum(begins) - 1, np.flatnonzero(begins)
            pairs = np.unique(run_of_row[tokens.row].astype(np.int64) * k + code)
            run_of, term_of = pairs // k, pairs % k
            ids = batch.column("doc_id").take(pa.array(first)).to_pylist()
            whole = batch.column("whole").take(pa.array(first)).to_numpy(zero_copy_only=False)
            own = lambda r: set(names.take(pa.array(term_of[run_of == r])).to_pylist())  # noqa: B023, E731
            last = len(first) - 1
            open_runs = {0, last}  # may go on from the batch before, or into the next
            if held and held[0] != ids[0]:
                yield given_up(*held)
                held = None
            terms_of_first = own(0) | (held[2] if held else set())
            if last:
                yield given_up(ids[0], whole[0], list(terms_of_first))
                held = (ids[last], whole[last], own(last))
            else:
                held = (ids[0], whole[0], terms_of_first)
            inner = ~np.isin(run_of, list(open_runs))
            closed = inner & whole[run_of]
            counts = np.bincount(term_of[closed], minlength=len(names))
            at = np.flatnonzero(counts)
            yield made(pa.nulls(len(at), id_kind), names.take(pa.array(at)), counts[at])
            parts = inner & ~closed
            yield made([ids[r] for r in run_of[parts]], names.take(pa.array(term_of[parts])), np.ones(int(parts.sum()), np.int64))
        if held:
            yield given_up(*held)

    columns = ["doc_id"] if by_row else ["doc_id", "whole"]
    return rows.select(*columns, column).mapInArrow(run_of_rows if by_row else run, f"doc_id {id_type.simpleString()}, term string, df long")
