"""Benchmark decontamination: test items found inside documents by containment.

Words are runs of anything but ASCII punctuation and white space, A-Z in lower case. An item's set
holds its distinct shingles of five words, or its whole sequence as one shingle if it has
fewer; an item without words is never found. A document contains an item if it has at least
80 % of the item's set.

The search is a MinHash one for containment. Items are partitioned by the size of their set. Of an item the
index holds its k smallest hashes, k being the partition's: so many that a document with 80 % of the largest set of
the partition can't miss all of them, so no contained item is missed, whatever the length of
the document. A document's shingles are looked up in those sketches; partitions whose items are too
large for the document are skipped. Candidates are verified against the item's whole set.
Hashes have 64 bits, and 80 % of a set have to agree before an item counts.

Equal texts of the benchmark are searched once and given back to all items that have them. The texts are taken in blocks of bounded size (a single longer
text is a block of its own), one brought to the driver and broadcast at a time; each is a search over the documents, so a worker holds one block. Nothing of the documents is shuffled, but
what is found joins its items. Repeated items and repeated documents are all
reported; null texts are empty; an empty benchmark contaminates nothing. Item ids are integers
or null. Columns beside those named may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.stored import kept_as_table
from wordloom.llm.wordspans import PUNCTUATION, U64, Slice, shingle_hashes, shingle_starts, slices

SHINGLE_WORDS = 5
LEAST_PERCENT = 80

# Text of the benchmark per broadcast block, and what the index of a block of such text takes at most.
BLOCK_BYTES = 8 << 20

FOUND = "array<struct<text_id: bigint, n_shared: bigint, n_item: bigint>>"
_FILTER_BITS = 20


def needed(size: int) -> int:
    """Least number of shared shingles."""
    return -(-LEAST_PERCENT * size // 100)


def _shingles(s: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of n words."""
    at = np.flatnonzero(shingle_starts(s.n_words, n))
    return s.text_of_word[at], shingle_hashes(s.word_hashes(), n)[at]


class _Lookup:
    """Hash -> numbers, for many hashes at once. A bit table answers for most hashes that are not there."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        order = np.lexsort((numbers, hashes))
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.numbers, self.first = numbers[order], np.append(first, len(order))
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self.hashes >> U64(64 - _FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """-> (which of the hashes, number), a row per hit."""
        which = np.flatnonzero(self.seen[hashes >> U64(64 - _FILTER_BITS)])
        at = np.searchsorted(self.hashes, hashes[which])
        at[at == len(self.hashes)] = 0
        there = self.hashes[at] == hashes[which]
        which, at = which[there], at[there]
        sizes = self.first[at + 1] - self.first[at]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(which, sizes), self.numbers[np.repeat(self.first[at], sizes) + within]


class Index:
    """Of a block of items: per shingle length the sketches by size partition, and the whole sets."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        self.sizes = np.zeros(len(items), np.int64)
        sets: dict[int, list[tuple[int, np.ndarray]]] = {}
        for s in slices(pa.array([t for _, t in items], pa.string()), lower=True, breaks=PUNCTUATION):
            words = s.word_hashes()
            for i in np.flatnonzero(s.n_words):
                own = words[s.first_word[i] : s.first_word[i + 1]]
                n = min(SHINGLE_WORDS, len(own))
                shingles = np.unique(shingle_hashes(own, n))
                self.sizes[s.first + i] = len(shingles)
                sets.setdefault(n, []).append((s.first + i, shingles))
        self.by_length: list[tuple[int, list[tuple[int, _Lookup]], _Lookup]] = []
        for n, members in sorted(sets.items()):
            partitions: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, own in members:
                partitions.setdefault(len(own).bit_length(), []).append((i, own))
            sketches = []
            for parts in partitions.values():
                sizes = [len(own) for _, own in parts]
                k = max(size - needed(size) + 1 for size in range(min(sizes), max(sizes) + 1))
                sketches.append((needed(min(sizes)), _lookup((i, own[:k]) for i, own in parts)))
            self.by_length.append((n, sketches, _lookup(members)))

    def contained(self, s: Slice) -> Iterable[tuple[int, int, int]]:
        """-> (text, item, shared shingles) of every item that a text of the slice contains."""
        for n, sketches, sets in self.by_length:
            text, hashes = _shingles(s, n)
            n_here = np.bincount(text, minlength=s.n)
            pairs = []
            for least, sketch in sketches:
                which, item = sketch.find(hashes)
                fits = n_here[text[which]] >= least
                pairs.append(np.unique(text[which[fits]] * len(self.ids) + item[fits]))
            candidates = np.unique(np.concatenate(pairs))
            if not len(candidates):
                continue
            wanted = np.zeros(s.n, bool)
            wanted[candidates // len(self.ids)] = True
            mine = np.flatnonzero(wanted[text])
            which, item = sets.find(hashes[mine])
            at = mine[which]
            hit = np.unique(np.rec.fromarrays([text[at] * len(self.ids) + item, hashes[at]]))
            pair, shared = np.unique(hit.f0, return_counts=True)
            good = (100 * shared >= LEAST_PERCENT * self.sizes[pair % len(self.ids)]) & np.isin(pair, candidates)
            yield from zip((pair[good] // len(self.ids)).tolist(), (pair[good] % len(self.ids)).tolist(), shared[good].tolist())


def _lookup(sets: Iterable[tuple[int, np.ndarray]]) -> _Lookup:
    sets = list(sets)
    return _Lookup(np.concatenate([own for _, own in sets]), np.repeat([i for i, _ in sets], [len(own) for _, own in sets]))


def distinct_texts(benchmark: DataFrame) -> DataFrame:
    """(item_id, text) -> (text_id, text): equal texts are searched once, whatever the number of items that have them."""
    return kept_as_table(benchmark.select("text").distinct().withColumn("text_id", F.monotonically_increasing_id()))


def text_blocks(texts: DataFrame, block_bytes: int | None = None) -> Iterator[list[tuple[int, str | None]]]:
    """(text_id, text) in blocks of about `block_bytes`, one after the other; a block goes to every worker."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n = -(-size // (block_bytes or BLOCK_BYTES))
    block = F.pmod(F.xxhash64("text"), F.lit(n))
    for b in range(n):
        yield [tuple(r) for r in texts.where(block == b).select("text_id", "text").collect()]


def found_texts(text: Column, spark: SparkSession, texts: list[tuple[int, str | None]]) -> Column:
    """The texts of one block that a text contains. Non-deterministic so that it is worked out once."""
    shared = spark.sparkContext.broadcast(Index(texts))

    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        index = shared.value
        found: list[list] = [[] for _ in range(len(texts))]
        for s in slices(texts, lower=True, breaks=PUNCTUATION):
            for text, item, n in index.contained(s):
                found[s.first + text].append((index.ids[item], n, int(index.sizes[item])))
        struct = pa.struct([("text_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64())])
        rows = [[dict(zip(("text_id", "n_shared", "n_item"), f)) for f in row] for row in found]
        return pa.array(rows, pa.list_(struct))

    return find.asNondeterministic()(text)


def found_items(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, item_id, n_shared, n_item) for every item that a document contains.

    Each block is a search of its own over the documents, so a worker holds one block.
    """
    texts = distinct_texts(benchmark)
    found = documents.select("doc_id", F.lit(None).cast(FOUND).alias("found")).limit(0)
    for block in text_blocks(texts):
        here = documents.select("doc_id", found_texts(F.col("text"), documents.sparkSession, block).alias("found"))
        found = found.union(here.where(F.size("found") > 0))
    items = benchmark.join(texts, benchmark["text"].eqNullSafe(texts["text"])).select("text_id", "item_id")
    return found.select("doc_id", F.inline("found")).join(items, "text_id").select("doc_id", "item_id", "n_shared", "n_item")


def without_items(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with their own columns. What one block leaves is written before the next one looks at it."""
    left = documents
    for i, block in enumerate(text_blocks(distinct_texts(benchmark))):
        held = (kept_as_table(left) if i else left).select(F.struct("*").alias("doc"))
        held = held.withColumn("found", found_texts(F.col("doc.text"), documents.sparkSession, block))
        left = held.where(F.size("found") == 0).select("doc.*")
    return left


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of `benchmark`, with their own columns."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: (doc_id, item_id, n_shared, n_item) for every item of `benchmark` that a document contains."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return found_items(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), benchmark)


SQL = r"""
WITH worded AS (
    SELECT row_number() OVER () AS row_no, doc_id AS id, true AS is_doc, text FROM documents
    UNION ALL SELECT row_number() OVER (), item_id, false, text FROM benchmark
), words AS (
    SELECT row_no, id, is_doc, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM worded
), items AS (
    SELECT row_no, id, w, least(5, len(w)) AS n FROM words WHERE NOT is_doc AND len(w) > 0
), item_shingles AS (
    SELECT DISTINCT row_no, id, n, array_to_string(w[i:i + n - 1], ' ') AS shingle
    FROM (SELECT row_no, id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), doc_shingles AS (
    SELECT DISTINCT row_no, id, n, array_to_string(w[i:i + n - 1], ' ') AS shingle
    FROM (SELECT row_no, id, n, w, unnest(range(1, len(w) - n + 2)) AS i
        FROM words CROSS JOIN (SELECT DISTINCT n FROM items) WHERE is_doc)
), sizes AS (
    SELECT row_no, count(*) AS n_item FROM item_shingles GROUP BY row_no
)
SELECT any_value(d.id) AS doc_id, any_value(i.id) AS item_id, count(*)::BIGINT AS n_shared, any_value(n_item)::BIGINT AS n_item
FROM doc_shingles d JOIN item_shingles i USING (n, shingle) JOIN sizes s ON s.row_no = i.row_no
GROUP BY d.row_no, i.row_no
HAVING 100 * count(*) >= 80 * any_value(n_item)
"""
