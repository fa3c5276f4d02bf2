"""Which hashes of a document do other documents have as well?

Most shingles of a corpus occur in one document only and can't link anything. This finds the others with a single
pass over the texts and a single exchange of 8 bytes per distinct hash of a slice: hashes are dealt to buckets by
their leading bits, as packed arrays instead of rows. A hash that several documents of a slice have is known to be
shared there and goes to its bucket once, without its documents; so no bucket gets more entries of a hash
than there are slices, however many documents have it.

A token is the leading 46 to 56 bits of a hash: those of its bucket and 40 more. Packed arrays hold 40 bits of
each hash, by document, and the numbers of the documents as differences, byte planes one after the other, compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.wordspans import U64, slices

SLICE_BYTES = 2 << 20
_MOST_ROWS = 0xFFFF  # of a slice; as a document's number it stands for "several"
_BITS = 40
_LOW = U64((1 << _BITS) - 1)  # of a token: what its bucket does not say

PACKED = "bucket int, row bigint, doc_id bigint, n bigint, packed binary"
PARTS = "row bigint, doc_id bigint, n bigint, token bigint, known array<bigint>"

# Slice -> (text of each hash, hash), every hash once per text.
Hashes = Callable[..., tuple[np.ndarray, np.ndarray]]


def distinct_pairs(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) without repeats, in order of the hash."""
    order = np.lexsort((text, hashes))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def _pieces(n: int, gaps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of what lies between gaps, in pieces of at most `_MOST_ROWS` rows."""
    for a, b in zip([0, *gaps.tolist()], [*gaps.tolist(), n]):
        for begin in range(a, b, _MOST_ROWS):
            yield begin, min(b, begin + _MOST_ROWS)


def _packer(of: Hashes, bits: int, lower: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("row").to_numpy(), batch.column("doc_id")
            # A slice is rows numbered without gaps: other files, or partitions strung together, begin another one.
            gaps = np.flatnonzero(np.diff(rows) != 1) + 1
            for begin, end in _pieces(batch.num_rows, gaps):
                part = batch.column("text").slice(begin, end - begin)
                for s in slices(part, lower=lower, limit=SLICE_BYTES):
                    at = begin + s.first
                    yield from _slice(s, rows[at : at + s.n], ids.slice(at, s.n))

    def _slice(s, rows: np.ndarray, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        text, hashes = of(s)
        text, hashes = distinct_pairs(text, hashes)
        n = np.bincount(text, minlength=s.n)
        hashes = tokens_of(hashes, bits).view(U64)
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        count = np.diff(np.append(first, len(hashes)))
        several = count > 1
        document = text[first]
        document[several] = _MOST_ROWS
        bucket = (hashes[first] >> U64(_BITS)).astype(np.int64)
        order = np.lexsort((document, bucket))
        values, document, bucket = (hashes[first] & _LOW)[order], document[order], bucket[order]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        blobs = [_pressed(values[a:b], document[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(values)))]
        yield _batch(bucket[cuts], np.full(len(cuts), rows[0]), None, None, blobs)
        # Of each document: its number of hashes and those that are known to be shared already.
        shared = np.repeat(several, count)
        tokens = hashes[shared].view(np.int64)
        order = np.argsort(text[shared], kind="stable")
        ends = np.cumsum(np.bincount(text[shared], minlength=s.n))
        tokens = tokens[order]
        own = [tokens[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)]
        yield _batch(np.full(s.n, -1), rows, ids, n, own)

    return pack


def tokens_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits - _BITS)).view(np.int64)


def _pressed(values: np.ndarray, documents: np.ndarray) -> bytes:
    """40-bit values and sorted 16-bit numbers."""
    steps = np.diff(documents, prepend=0).astype("<u2")
    planes = values.view(np.uint8).reshape(-1, 8)[:, : _BITS // 8].T.tobytes() + steps.view(np.uint8).reshape(-1, 2).T.tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpressed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    width = _BITS // 8
    planes = np.frombuffer(pa.decompress(blob[4:], n * (width + 2), "zstd", asbytes=True), np.uint8).reshape(width + 2, n)
    values = np.zeros((n, 8), np.uint8)
    values[:, :width] = planes[:width].T
    steps = np.ascontiguousarray(planes[width:].T).view("<u2").ravel()
    return values.view(U64).ravel(), np.cumsum(steps, dtype=np.int64)


def _batch(bucket, row, ids, n, blobs) -> pa.RecordBatch:
    size = len(blobs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket, pa.int32()),
            pa.array(row, pa.int64()),
            ids if ids is not None else pa.nulls(size, pa.int64()),
            pa.array(n, pa.int64()) if n is not None else pa.nulls(size, pa.int64()),
            pa.array(blobs, pa.binary()),
        ],
        ["bucket", "row", "doc_id", "n", "packed"],
    )


def _parts(rows, ids=None, n=None, tokens=None, known=None) -> pa.RecordBatch:
    none = lambda x, kind=pa.int64(): pa.nulls(len(rows), kind) if x is None else x
    columns = [pa.array(rows), none(ids), none(n), none(tokens), none(known, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n", "token", "known"])


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by bucket: entries of a hash from two slices, or known to be of several documents, are shared."""
    bucket, bases, blobs = None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(blobs) == 0:
            return
        entries = [_unpressed(b) for b in blobs]
        base = np.repeat(np.array(bases, np.int64), [len(v) for v, _ in entries])
        value, document = np.concatenate([v for v, _ in entries]), np.concatenate([d for _, d in entries])
        order = np.argsort(value, kind="stable")
        value, document, base = value[order], document[order], base[order]
        same = value[1:] == value[:-1]
        shared = np.zeros(len(value), bool)
        shared[1:] |= same
        shared[:-1] |= same
        shared &= document != _MOST_ROWS
        if shared.any():
            tokens = (U64(bucket) << U64(_BITS) | value[shared]).view(np.int64)
            yield _parts(base[shared] + document[shared], tokens=pa.array(tokens))

    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        known = np.flatnonzero(buckets < 0)
        if len(known):
            some = batch.take(pa.array(known))
            lists = some.column("packed").to_pylist()
            offsets = np.append(0, np.cumsum([len(x) // 8 for x in lists])).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(lists), np.int64)))
            yield _parts(some.column("row").to_numpy(), some.column("doc_id"), some.column("n"), known=tokens)
        for i in np.flatnonzero(buckets >= 0):
            if buckets[i] != bucket:
                yield from flush()
                bucket, bases, blobs = int(buckets[i]), [], []
            bases.append(batch.column("row")[i].as_py())
            blobs.append(batch.column("packed")[i].as_py())
    yield from flush()


def token_bits(spark: SparkSession) -> int:
    """Bits of a hash that name its bucket: some buckets for each task."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(6, min(16, (8 * tasks - 1).bit_length()))


def shared_tokens(documents: DataFrame, of: Hashes, lower: bool = False) -> DataFrame:
    """(row, doc_id, text), rows numbered, best without gaps -> (row, doc_id, n, tokens), a row per document.

    `n` is the number of distinct hashes of the document, `tokens` those that another row has too, unordered.
    """
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = token_bits(documents.sparkSession)
    packed = documents.select("row", "doc_id", "text").mapInArrow(_packer(of, bits, lower), PACKED)
    # Rows of documents are dealt evenly, those of buckets meet.
    deal = F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(-1 - F.col("row"))
    dealt = packed.repartition(tasks, deal).sortWithinPartitions("bucket")
    # What buckets find comes as single tokens: dealt as they are, as adding them up before would only make them larger.
    parts = dealt.mapInArrow(_matched, PARTS).repartition(tasks, "row")
    return parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n").alias("n"),
        F.concat(F.collect_list("token"), F.flatten(F.collect_list("known"))).alias("tokens"),
    )
