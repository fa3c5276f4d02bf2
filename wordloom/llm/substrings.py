"""Substring dedup: word windows that an earlier document has, found with FM-indexes per shard.

A window is `WINDOW` consecutive words of a document. Each word covered by a window that also starts in a
document with a smaller id goes; windows are judged on the input. The steps:

1. Anchors. The anchor of a window is the smallest hash of its five-word shingles; equal windows have equal anchors. A window
   whose anchor no other document has is in no other document. Shared anchors come from `common_shingles`.
2. Segments. Consecutive windows with one shared anchor are a segment of the document. Segments are sorted by anchor and cut
   into shards between anchors, so equal windows meet in one shard, a shard holds at most `SHARD_BYTES` of words, and the shards
   together are as large as what may repeat. Equal segments of a batch of documents are sent once, with their smallest id.
3. Index. Each shard builds an FM-index (wavelet matrix over the Burrows-Wheeler transform) of its distinct segments, streams
   them through it by backward search, and keeps matching statistics up to the window length: the interval
   of each window, and the smallest document id in it.
4. An anchor whose segments alone are more than a shard (a phrase that very many documents have in different surroundings) is
   taken apart into windows. Those are sorted by their content and cut into shards of the same size between different windows,
   with an FM-index each; a join on content tells the segments what their windows found.
5. What a segment learns about its windows goes back to the documents that have it, by a join on its content.

Null text has no words. A null id is neither smaller nor larger than others: such documents keep all their words
and take none from others. Documents with equal ids take nothing from each other. Windows are equal if 40 bits of the
hashes of all their words are. Columns other than `doc_id` and `text` stay outside. The query numbers rows by their file and
their place in it, so that each of its scans gives the same numbers, however it is split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common_shingles import shared_tokens, token_bits, tokens_of
from wordloom.llm.fm_index import FMIndex, range_minima
from wordloom.llm.stored import placed
from wordloom.llm.wordspans import U64, Slice, mixed, shingle_hashes, slices

WINDOW = 13
ANCHOR_WORDS = 5
NO_ID = np.iinfo(np.int64).max
WORD_BYTES = 5
SLICE_BYTES = 2 << 20
SHARD_BYTES = 4 << 20  # of words, five bytes each
SEARCHED = 1 << 17  # windows searched at a time

SEGMENTS = "row bigint, doc_id bigint, start int, k1 bigint, k2 bigint, shard int, copies int, words binary"
FIRSTS = "k1 bigint, k2 bigint, firsts array<bigint>"
WINDOWS = "shard int, doc_id bigint, copies int, words binary"
PLACES = "k1 bigint, k2 bigint, at int, w1 bigint, w2 bigint"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def _windows(s: Slice, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, anchor) of every window of the slice, by its first word."""
    begins = np.flatnonzero(np.arange(len(words)) + WINDOW <= np.repeat(s.first_word[1:], s.n_words))
    shingles = shingle_hashes(words, ANCHOR_WORDS)
    anchors = shingles[begins]
    for j in range(1, WINDOW - ANCHOR_WORDS + 1):
        np.minimum(anchors, shingles[begins + j], out=anchors)
    # Least hashes are small numbers; mixed again they spread over the buckets.
    return begins, mixed(anchors)


def anchors(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    begins, anchor = _windows(s, s.word_hashes())
    return s.text_of_word[begins], anchor


_FACTORS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))


def _narrow(words: np.ndarray) -> np.ndarray:
    return words >> U64(64 - 8 * WORD_BYTES)


def _packed(words: np.ndarray) -> np.ndarray:
    """Narrow words as rows of bytes."""
    return np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]


def _unpacked(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // WORD_BYTES, 8), np.uint8)
    wide[:, :WORD_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, WORD_BYTES)
    return wide.view(U64).ravel()


def _content_keys(words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each range of words."""
    keys = []
    n = len(words)
    for factor in _FACTORS:
        power = np.full(n + 1, factor, U64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        inverse = np.full(n + 1, pow(int(factor), -1, 1 << 64), U64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        sums = np.append(U64(0), np.cumsum(mixed(words ^ factor) * power[:-1]))
        keys.append(mixed((sums[stop] - sums[start]) * inverse[start] ^ (stop - start).astype(U64)).view(np.int64))
    return keys


def _segmenter(bits: int, send: str):
    """send: `members` for where segments are, `contents` for what they hold."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            lists = batch.column("tokens")
            shared = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(rows)), lists.value_lengths().fill_null(0).to_numpy())
            for s in slices(batch.column("text"), limit=SLICE_BYTES):
                if s.n_words.sum() < WINDOW:
                    continue
                yield from _of_slice(s, rows, ids, shared, owner)

    def _of_slice(s: Slice, rows, ids, shared, owner) -> Iterator[pa.RecordBatch]:
        words = s.word_hashes()
        begins, anchor = _windows(s, words)
        text = s.text_of_word[begins] + s.first
        mine = (owner >= s.first) & (owner < s.first + s.n)
        known = mixed(shared[mine].view(U64) ^ mixed(owner[mine].astype(U64)))
        token = tokens_of(anchor, bits)
        keep = np.isin(mixed(token.view(U64) ^ mixed(text.astype(U64))), known)
        begins, token, text = begins[keep], token[keep], text[keep]
        if not len(begins):
            return
        new = np.ones(len(begins), bool)
        new[1:] = (begins[1:] != begins[:-1] + 1) | (token[1:] != token[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(begins)) - 1
        start, stop = begins[first], begins[last] + WINDOW
        words = _narrow(words)
        k1, k2 = _content_keys(words, start, stop)
        row, doc = rows[text[first]], ids[text[first]]
        shard = _shard_key(token[first])
        none = pa.nulls(len(first), pa.binary())
        if send == "members":
            within = start - s.first_word[text[first] - s.first]
            yield _segment_batch(row, doc, within, k1, k2, shard, np.ones(len(first)), none)
            return
        order = np.lexsort((doc, k2, k1))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        once = order[fresh]
        copies = np.diff(np.append(np.flatnonzero(fresh), len(order)))
        packed = _packed(words)
        held = pa.array([packed[a:b].tobytes() for a, b in zip(start[once], stop[once])], pa.binary())
        yield _segment_batch(row[once], doc[once], start[once], k1[once], k2[once], shard[once], copies, held)

    return segments


def _segment_batch(row, doc, start, k1, k2, shard, copies, words) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = [pa.array(np.asarray(x).astype(k.to_pandas_dtype())) for x, k in zip((row, doc, start, k1, k2, shard, copies), kinds)]
    return pa.RecordBatch.from_arrays([*columns, words], _names(SEGMENTS))


def _shard_key(keys: np.ndarray) -> np.ndarray:
    """What decides a shard, in 31 bits; keys that share them stay together."""
    return (mixed(keys.view(U64)) >> U64(33)).astype(np.int32)


def _tables(pieces: list[list]) -> pa.Table:
    """Pieces (batch, from, to) as one table."""
    return pa.Table.from_batches([batch.slice(a, b - a) for batch, a, b in pieces])


def _add(pieces: list[list], more: list[list]) -> None:
    for batch, a, b in more:
        if pieces and pieces[-1][0] is batch and pieces[-1][2] == a:
            pieces[-1][2] = b
        else:
            pieces.append([batch, a, b])


def _shards(batches: Iterator[pa.RecordBatch], most: int, divide: bool) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by key -> shards of at most `most` bytes of words, whole keys each.

    A key with more than that by itself comes in several tables if it may be divided, all of them marked; whether it
    does depends on its bytes alone, not on the order of its rows.
    """
    held, held_bytes = [], 0
    key, own, own_bytes, large = None, [], 0, False

    def closed() -> Iterator[tuple[pa.Table, bool]]:
        nonlocal held, held_bytes
        if large:
            if own:
                yield _tables(own), True
            return
        if held and held_bytes + own_bytes > most:
            yield _tables(held), False
            held, held_bytes = [], 0
        _add(held, own)
        held_bytes += own_bytes

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("shard").to_numpy()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.add.reduceat(pa.compute.binary_length(batch.column("words")).to_numpy().astype(np.int64), starts)
        for a, b, n, k in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], sizes.tolist(), keys[starts].tolist()):
            if k != key:
                yield from closed()
                key, own, own_bytes, large = k, [], 0, False
            _add(own, [[batch, a, b]])
            own_bytes += n
            if divide and own_bytes > most:
                yield _tables(own), True
                own, own_bytes, large = [], 0, True
    yield from closed()
    if held:
        yield _tables(held), False


class _Contents:
    """The distinct segments of a table, with the least document and the number of copies of each."""

    def __init__(self, table: pa.Table):
        doc, copies = (table.column(c).to_numpy() for c in ("doc_id", "copies"))
        blobs = table.column("words").to_pylist()
        ends = np.cumsum([len(b) // WORD_BYTES for b in blobs])
        starts = np.append(0, ends[:-1])
        words = _unpacked(b"".join(blobs))
        k1, k2 = _content_keys(words, starts, ends)
        order = np.lexsort((doc, k2, k1))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        once = order[fresh]
        self.k1, self.k2, self.least = k1[once], k2[once], doc[once]
        self.copies = np.add.reduceat(copies[order], np.flatnonzero(fresh))
        self.lengths = (ends - starts)[once]
        self.ends = np.cumsum(self.lengths)
        self.words = words[np.repeat(starts[once] - self.ends + self.lengths, self.lengths) + np.arange(self.lengths.sum())]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, segment) of every window."""
        begins = np.flatnonzero(np.arange(len(self.words)) + WINDOW <= np.repeat(self.ends, self.lengths))
        return begins, np.repeat(np.arange(len(self.lengths)), self.lengths - WINDOW + 1)


def _firsts(c: _Contents) -> np.ndarray:
    """The least document that has each window, by an FM-index of the segments."""
    # The sequence: each segment's words, numbered from 2, then a 1; at its end the only 0.
    names, number = np.unique(c.words, return_inverse=True)
    segment = np.repeat(np.arange(len(c.lengths)), c.lengths)
    text = np.ones(len(c.words) + len(c.lengths) + 1, np.int64)
    text[-1] = 0
    place = np.arange(len(c.words)) + segment
    text[place] = number + 2
    of_place = np.full(len(text), NO_ID)
    of_place[place] = c.least[segment]
    index = FMIndex(text, len(names) + 2, of_place)
    windows = place[c.windows()[0]]
    start, stop = np.empty(len(windows), np.int64), np.empty(len(windows), np.int64)
    for i in range(0, len(windows), SEARCHED):
        some = windows[i : i + SEARCHED]
        start[i : i + SEARCHED], stop[i : i + SEARCHED] = index.intervals([text[some + j] for j in range(WINDOW)])
    return range_minima(index.marks, start, stop)


def _indexed(most: int):
    """Contents sorted by anchor -> what is known about the windows of those that matter, shard by shard."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, large in _shards(batches, most, divide=True):
            if not large:
                yield from _of_shard(_Contents(table))

    def _of_shard(c: _Contents) -> Iterator[pa.RecordBatch]:
        first = _firsts(c)
        n_windows = c.lengths - WINDOW + 1
        starts = np.append(0, np.cumsum(n_windows)[:-1])
        earlier = np.add.reduceat(first < np.repeat(c.least, n_windows), starts) > 0
        useful = np.flatnonzero((c.copies > 1) | earlier)
        if not len(useful):
            return
        keep = np.isin(np.repeat(np.arange(len(c.lengths)), n_windows), useful)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_windows[useful])).astype(np.int32)), pa.array(first[keep]))
        yield pa.RecordBatch.from_arrays([pa.array(c.k1[useful]), pa.array(c.k2[useful]), lists], ["k1", "k2", "firsts"])

    return firsts


def _taken_apart(most: int, send: str):
    """Contents sorted by anchor -> the windows of anchors that are too large for a shard.

    send: `contents` for what different windows hold, `places` for where they stand in segments.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, large in _shards(batches, most, divide=True):
            if large:
                yield _of_table(_Contents(table))

    def _of_table(c: _Contents) -> pa.RecordBatch:
        begins, segment = c.windows()
        w1, w2 = _content_keys(c.words, begins, begins + WINDOW)
        if send == "places":
            at = (begins - (c.ends - c.lengths)[segment]).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (c.k1[segment], c.k2[segment], at, w1, w2)], _names(PLACES))
        least = c.least[segment]
        order = np.lexsort((least, w2, w1))
        fresh = np.flatnonzero(np.append(True, (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1])))
        once = order[fresh]
        copies = np.add.reduceat(np.minimum(c.copies, 2)[segment][order], fresh)
        packed = _packed(c.words)[begins[once][:, None] + np.arange(WINDOW)].reshape(len(once), -1)
        held = pa.array([row.tobytes() for row in packed], pa.binary())
        columns = [pa.array(_shard_key(w1[once])), pa.array(least[once]), pa.array(copies.astype(np.int32)), held]
        return pa.RecordBatch.from_arrays(columns, _names(WINDOWS))

    return windows


def _indexed_windows(most: int):
    """Windows sorted by content -> (w1, w2, first) of those that stand more than once, shard by shard."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in _shards(batches, most, divide=False):
            c = _Contents(table)
            several = c.copies > 1
            columns = [x[several] for x in (c.k1, c.k2, _firsts(c))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["w1", "w2", "first"])

    return firsts


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def repeated_windows(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row, doc_id, text) -> (row, starts): for each document the words where windows begin that an earlier one has."""
    spark = documents.sparkSession
    bits = token_bits(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = shared_tokens(documents, anchors).select("row", "tokens").where(F.size("tokens") > 0)
    held = documents.join(known, "row").select("row", "doc_id", "text", "tokens")
    contents = held.mapInArrow(_segmenter(bits, "contents"), SEGMENTS).select("shard", "doc_id", "copies", "words")
    by_anchor = contents.repartition(tasks, "shard").sortWithinPartitions("shard")
    members = held.mapInArrow(_segmenter(bits, "members"), SEGMENTS).where(F.col("doc_id") < NO_ID)
    members = members.select("row", "doc_id", "start", "k1", "k2").hint("merge")

    found = members.join(by_anchor.mapInArrow(_indexed(shard_bytes), FIRSTS), ["k1", "k2"])
    marked = F.transform("firsts", lambda first, i: F.when(first < F.col("doc_id"), F.col("start") + i))
    starts = F.filter(marked, lambda x: x.isNotNull())
    found = found.select("row", starts.alias("starts")).where(F.size("starts") > 0)

    # Anchors beyond a shard, window by window. A hot window has many places: a join, whose hot keys are split.
    windows = by_anchor.mapInArrow(_taken_apart(shard_bytes, "contents"), WINDOWS)
    windows = windows.repartition(tasks, "shard").sortWithinPartitions("shard")
    firsts = windows.mapInArrow(_indexed_windows(shard_bytes), "w1 bigint, w2 bigint, first bigint")
    places = by_anchor.mapInArrow(_taken_apart(shard_bytes, "places"), PLACES).distinct()
    placed_firsts = places.hint("merge").join(firsts, ["w1", "w2"]).select("k1", "k2", "at", "first")
    apart = members.join(placed_firsts, ["k1", "k2"]).where(F.col("first") < F.col("doc_id"))
    apart = apart.select("row", F.array(F.col("start") + F.col("at")).alias("starts"))

    return found.union(apart).groupBy("row").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, digests = [], [], []
        for text, starts in zip(batch.column("text"), batch.column("starts")):
            words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
            n_words.append(len(words))
            if starts.is_valid:
                steps = np.zeros(len(words) + 1, np.int64)
                at = starts.values.to_numpy()
                np.add.at(steps, at, 1)
                np.add.at(steps, at + WINDOW, -1)
                gone = np.cumsum(steps[:-1]) > 0
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())], _names(RESULT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: (doc_id, n_words, n_removed, kept_sha256) for every row of `documents`."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = placed(documents.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")))
    found = repeated_windows(rows)
    return rows.join(found, "row", "left").select("doc_id", "text", "starts").mapInArrow(_cleaned, RESULT)


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
    SELECT row_no, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM docs
), runs AS (
    SELECT row_no, doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY row_no ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS run
    FROM words
), windows AS (
    SELECT row_no, doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first FROM runs WHERE i + 12 <= n
), gone AS (
    SELECT DISTINCT row_no, i + j AS i FROM windows CROSS JOIN (SELECT unnest(range(13)) AS j) WHERE first < doc_id
), kept AS (
    SELECT row_no, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN gone USING (row_no, i)
    GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_no)
"""
