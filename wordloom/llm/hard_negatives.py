"""Hard negatives: for anchors and their nearest rows of the same label, the nearest rows of other labels inside a score window.

The score of two vectors is the inner product of their components, each made an integer by `floor(SCALE * x)`. Whether two rows
can reach a score is first asked of their angles to a few reference directions, which are stored with every
row: if these differ by d and add up to s, the angle between the rows is at least d and at most s or 2 pi - s. The cosines of the
closest such bounds over all directions, times both norms, bound the score from above and below; a margin far above
the rounding of angles and products makes the bounds safe. Only where they overlap the window asked for are the integers
multiplied. The directions decide how much is left out, never a result: they are the mean directions of the
most frequent labels in a sample of `SAMPLED` rows, or what the caller gives.

Rows stand in blocks by label, `BLOCK_ROWS` rows each on average, a label of any size in as many blocks as it needs; anchors
likewise. A block of anchors meets, one after the other, the blocks of its label for the positives and then all blocks for the
negatives; each meeting is a row of its own, so it is one unit of work of bounded memory and any task can do it. A meeting gives at most as many rows per
anchor as are asked for in the end, ranked windows cut those to the best per task before the exchange. No limit
is set on anything else: the bounds are per meeting and the result is exact.

Rows with null label, vector or `vec_id`, and with a null or non-finite component, take no part. A shorter vector counts as filled up
with zeros, the empty one has score 0 with everything. Rows that repeat are rows of their own, also beside an anchor with the same id; each
row that is an anchor has its own results, and so has each positive. Equal scores are ranked by `vec_id`. Scores that do not fit into 64 bits count as the nearest that does. Anchors
without positives, and positives whose window is empty, give no rows; so does an empty table. Columns beside `vec_id`, `embedding` and `label` may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.stored import kept_as_table

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 10
# A negative score times 100 lies between these shares of the positive score.
LOW, HIGH = 30, 90
REFERENCES = 8
SAMPLED = 2_000
BLOCK_ROWS = 4_096
BLOCK_ANCHORS = 1_024
# Anchors of a block are compared so many at a time.
STRIP = 64
# Angles are right to about 1e-8 (arc cosines near 1), products to 1e-15 of the norms: a wide margin above both.
ANGLE_MARGIN, SCORE_MARGIN = 1e-6, 1e-6
LIMIT = 2**63 - 1

BLOCK = 1 << 24  # blocks of one part
ROW = "struct<uid: long, vec_id: long, label: long, norm: double, angles: array<double>, embedding: array<double>>"
FOUND = "uid long, anchor_id long, positive_id long, positive_score long, place int, negative_id long, negative_score long"


def _matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list array, shorter ones filled up with zeros."""
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    width = max(width or 0, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width))
    if len(sizes) and width:
        out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _quantised(vectors: np.ndarray) -> np.ndarray:
    """Integers, kept in doubles, which hold them exactly."""
    return np.floor(SCALE * vectors)


def _angles(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Of each row to each direction; 0 for rows without a direction."""
    width = max(vectors.shape[1], references.shape[1])
    wide = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
    unit = wide(vectors) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(unit @ wide(references).T, -1, 1))


def valid_rows(embeddings: DataFrame) -> DataFrame:
    """The rows that take part -> (vec_id, label, embedding)."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where("label is not null and embedding is not null and vec_id is not null").where(~odd)
    return rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))


def directions(rows: DataFrame, n: int = REFERENCES, sampled: int = SAMPLED) -> np.ndarray:
    """Mean directions of the n most frequent labels among `sampled` rows drawn by a hash; few rows, so they come to the driver."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sampled).select("label", "embedding").toArrow()
    vectors = _quantised(_matrix(drawn.column("embedding").combine_chunks()))
    labels, of = np.unique(drawn.column("label").to_numpy(), return_inverse=True)
    norms = np.linalg.norm(vectors, axis=1)
    sums = np.zeros((len(labels), vectors.shape[1]))
    np.add.at(sums, of, vectors / np.where(norms > 0, norms, 1)[:, None])
    means = sums[np.argsort(-np.bincount(of, minlength=len(labels)), kind="stable")[:n]]
    length = np.linalg.norm(means, axis=1)
    return means[length > 0] / length[length > 0][:, None]


def measured(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """(vec_id, label, embedding) -> the same with the norm of the integer vector and its angles to the references."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _quantised(_matrix(batch.column("embedding")))
            norms = np.linalg.norm(vectors, axis=1)
            angles = _angles(vectors, norms, references)
            ends = np.arange(len(norms) + 1, dtype=np.int32) * angles.shape[1]
            angles = pa.ListArray.from_arrays(pa.array(ends), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), angles], names=[*batch.schema.names, "norm", "angles"])

    return rows.mapInArrow(run, "vec_id long, label long, embedding array<double>, norm double, angles array<double>")


def _parts(rows: DataFrame, parts: int, size: int) -> DataFrame:
    """-> (part, blocks): how many blocks the rows of a part make. A part holds whole labels."""
    part = F.pmod(F.xxhash64("label"), F.lit(parts))
    return rows.groupBy(part.alias("part")).agg(F.ceil(F.count("*") / size).alias("blocks"))


def _blocked(rows: DataFrame, parts: int, size: int, *more: str) -> DataFrame:
    """-> (part, block, rows): the rows of a block as one list; `rows` have the fields of ROW and `more`."""
    part = F.pmod(F.xxhash64("label"), F.lit(parts)).alias("part")
    entry = F.struct("uid", "vec_id", "label", "norm", "angles", "embedding", *more)
    dealt = rows.select(part, F.xxhash64("uid").alias("deal"), entry.alias("entry")).join(_parts(rows, parts, size), "part")
    block = F.col("part") * BLOCK + F.pmod("deal", "blocks")
    return dealt.groupBy("part", block.alias("block")).agg(F.collect_list("entry").alias("rows"))


class _Block:
    """A list of rows as arrays."""

    def __init__(self, rows: pa.StructArray, width: int = 0):
        self.uid, self.vec_id, self.label = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("uid", "vec_id", "label"))
        self.norm = rows.field("norm").to_numpy(zero_copy_only=False)
        self.angles = _matrix(rows.field("angles"))
        self.vectors = _quantised(_matrix(rows.field("embedding"), width))
        self.peak = float(np.abs(self.vectors).max(initial=0))


def _bounds(a: _Block, strip: slice, b: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of some anchors with all rows of a block."""
    least = np.zeros((len(a.norm[strip]), len(b.norm)))
    most = np.full(least.shape, np.pi)
    for x, y in zip(a.angles[strip].T, b.angles.T):
        np.maximum(least, np.abs(x[:, None] - y), out=least)
        both = x[:, None] + y
        np.minimum(most, np.minimum(both, 2 * np.pi - both), out=most)
    norms = a.norm[strip][:, None] * b.norm
    margin = SCORE_MARGIN * norms + 1
    upper = norms * np.cos(np.maximum(least - ANGLE_MARGIN, 0)) + margin
    lower = norms * np.cos(np.minimum(most + ANGLE_MARGIN, np.pi)) - margin
    return np.clip(lower, -LIMIT, LIMIT), np.clip(upper, -LIMIT, LIMIT)


def _scores(anchor: np.ndarray, rows: np.ndarray, peak: float) -> np.ndarray:
    """Integer inner products; in doubles where these hold every sum exactly, in Python's integers otherwise."""
    if peak * len(anchor) < 2.0**53:
        return (rows @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    exact = (sum(int(x) * y for x, y in zip(row, whole)) for row in rows)
    return np.array([max(-LIMIT - 1, min(LIMIT, s)) for s in exact], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n first by falling score and rising id."""
    return np.lexsort((ids, ~scores))[:n]  # ~s falls as s rises, without overflow


def _meetings(kernel: Callable, schema: str) -> Callable[[DataFrame], DataFrame]:
    """Rows (anchors, rows) of two lists -> what `kernel` makes of each meeting."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("rows").slice(i, 1).flatten()
                anchors = batch.column("anchors").slice(i, 1).flatten()
                b = _Block(rows)
                a = _Block(anchors, b.vectors.shape[1])
                if a.vectors.shape[1] > b.vectors.shape[1]:
                    b = _Block(rows, a.vectors.shape[1])
                columns = zip(*kernel(a, b, anchors))
                arrays = [pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)]
                if arrays:
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return lambda pairs: pairs.select("anchors", "rows").mapInArrow(run, schema)


def _strips(a: _Block) -> Iterator[slice]:
    return (slice(i, min(i + STRIP, len(a.uid))) for i in range(0, len(a.uid), STRIP))


def _positive_kernel(n: int) -> Callable:
    """Per anchor the n first rows of its label among those of the block. What n rows are sure to reach the others have to be able to."""

    def kernel(a: _Block, b: _Block, _: pa.Array) -> Iterator[tuple]:
        peak = a.peak * b.peak
        for strip in _strips(a):
            lower, upper = _bounds(a, strip, b)
            usable = (a.label[strip][:, None] == b.label) & (a.uid[strip][:, None] != b.uid)
            for i in range(strip.stop - strip.start):
                at = np.flatnonzero(usable[i])
                if len(at) > n:
                    sure = np.partition(lower[i, at], len(at) - n)[len(at) - n]
                    at = at[upper[i, at] >= sure]
                if len(at):
                    scores = _scores(a.vectors[strip.start + i], b.vectors[at], peak)
                    best = _best(scores, b.vec_id[at], n)
                    yield np.full(len(best), a.uid[strip.start + i]), b.uid[at[best]], b.vec_id[at[best]], scores[best]

    return kernel


def window_of(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The integers s with low * score <= 100 * s <= high * score, as far as 64 bits go."""
    return max(-(-low * score // 100), -LIMIT), min(high * score // 100, LIMIT)


def _negative_kernel(n: int, low: int, high: int) -> Callable:
    """Per anchor and positive the n first rows of other labels in the window of that positive."""

    def kernel(a: _Block, b: _Block, anchors: pa.Array) -> Iterator[tuple]:
        peak = a.peak * b.peak
        positives = anchors.field("positives").to_pylist()
        for strip in _strips(a):
            lower, upper = _bounds(a, strip, b)
            other = a.label[strip][:, None] != b.label
            for i in range(strip.stop - strip.start):
                own = positives[strip.start + i]
                windows = [window_of(p["score"], low, high) for p in own]
                open_ = [(f, t) for f, t in windows if f <= t]
                if not open_:
                    continue
                within = (upper[i] >= min(f for f, _ in open_)) & (lower[i] <= max(t for _, t in open_))
                at = np.flatnonzero(within & other[i])
                scores = _scores(a.vectors[strip.start + i], b.vectors[at], peak)
                order = _best(scores, b.vec_id[at], len(at))
                ranked, ids = scores[order], b.vec_id[at][order]
                for p, (f, t) in zip(own, windows):
                    # Ranked scores fall, so a window is a slice; ~s rises as s falls.
                    start = np.searchsorted(~ranked, np.int64(~t), "left")
                    stop = np.searchsorted(~ranked, np.int64(~f), "right")
                    k = min(stop, start + n) - start
                    if k > 0:
                        same = lambda x, kind=np.int64: np.full(k, x, kind)  # noqa: B023, E731
                        yield (
                            same(a.uid[strip.start + i]), same(a.vec_id[strip.start + i]), same(p["vec_id"]), same(p["score"]),
                            same(p["place"], np.int32), ids[start : start + k], ranked[start : start + k],
                        )

    return kernel


def _first(found: DataFrame, of: list[str], score: str, vec_id: str, n: int, *tie: str) -> DataFrame:
    """The n first rows of each group with their `rank`."""
    order = Window.partitionBy(*of).orderBy(F.desc(score), F.asc(vec_id), *tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mined(
    embeddings: DataFrame,
    anchors: str = "vec_id % 100 = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    references: np.ndarray | None = None,
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """-> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` is the condition of the rows to ask for; `low` and `high` are per cent of the positive score.
    """
    rows = valid_rows(embeddings)
    rows = measured(rows, directions(rows) if references is None else references)
    # Rows are named once, in the table written here.
    rows = kept_as_table(rows.withColumn("uid", F.monotonically_increasing_id()))
    parts = max(1, -(-rows.count() // block_rows))
    blocks = kept_as_table(_blocked(rows, parts, block_rows))
    of_part = _parts(rows, parts, block_rows)
    asked = rows.where(anchors)

    def meet(asking: DataFrame, parts_of: DataFrame, *more: str) -> DataFrame:
        """Blocks of anchors beside the blocks of their parts."""
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        to = asking.join(parts_of, "part").select(F.col("rows").alias("anchors"), "part", each.alias("at"))
        return to.select("anchors", (F.col("part") * BLOCK + F.col("at")).alias("block")).join(blocks.select("block", "rows"), "block")

    near = _meetings(_positive_kernel(positives), "uid long, positive_uid long, vec_id long, score long")(
        meet(_blocked(asked, parts, block_anchors), of_part)
    )
    near = _first(near, ["uid"], "score", "vec_id", positives, "positive_uid")
    entry = F.struct(F.col("rank").alias("place"), "vec_id", "score")
    near = near.groupBy("uid").agg(F.array_sort(F.collect_list(entry)).alias("positives"))
    asking = _blocked(asked.join(near, "uid"), parts, block_anchors, "positives")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    found = _meetings(_negative_kernel(negatives, low, high), FOUND)(
        meet(asking.select("rows", everywhere.alias("part")), of_part)
    )
    found = _first(found, ["uid", "place"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(embeddings: DataFrame) -> DataFrame:
    """Wrong labels on purpose: every seventh id has the next of ten."""
    label = F.col("label").cast("long")
    return embeddings.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: hard negatives of every anchor of `embeddings`."""
    return mined(relabelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


SQL = f"""
WITH rows AS (
    SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE:.0f} * x::DOUBLE)::HUGEINT) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid, b.vec_id, a.label = b.label AS same,
        coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM rows a JOIN rows b ON a.uid <> b.uid WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) <= {POSITIVES}
), found AS (
    SELECT p.anchor, p.uid, p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
    WHERE {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= {NEGATIVES}
"""
