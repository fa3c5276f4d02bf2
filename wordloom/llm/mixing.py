"""Mixing sources to target weights, in blocks.

The words of a source are laid end to end and cut into blocks of fixed length (the last one may
be shorter). A source's target, in words, becomes a number of slots of the output, and the
slots of all sources are dealt to output shards: the counts of a source over the shards are a
multinomial draw of its slots, so a shard's counts over the sources are one too, given the
totals. Slots of a source are numbered through its shards; number i takes the block that a pseudorandom
permutation of the source's block indices gives for i, a new permutation for every pass
through the source. Blocks are joined by (source, index), with their words: the mix is a table of pieces, what a
block has from one document, by shard, slot and place in the block, and how much was taken of a document is counted in the words of that table.

A pass takes each block once, so a block is taken at most as often as there are passes begun. With
targets of at most twice the size, no document is taken more than twice.

Words stand in their source by ranges of a hash of id and text, and in a range by id (null ids first), size and that hash; the offset of a
document is what stands before it in its range and in earlier ranges, so no window holds more than a range, of about
`RANGE_WORDS` words whatever the size of the source. Repeated rows follow each other. All
draws are hashes of the seed, the source and the slot: reruns agree, whatever the partitioning.
Documents without a word take part with size 0 and are never taken. A null source is a source like any
other and comes last. An empty table gives an empty mix. Texts move twice, to their range and, cut into pieces, to their block; words are joined by single blanks there.
Only `doc_id`, `source` and `text` are read, so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions.text import bound
from wordloom.llm.stored import kept_as_table

WORD_BREAKS = r"[\x20\x09-\x0D]+"

# Weights by the rank of the source, the size of the mix, the most a source may give.
WEIGHTS = (5.0, 2.0, 1.0)
MIX_SHARE = 1.5
MOST_PASSES = 2.0

BLOCK_WORDS = 128
SHARD_SLOTS = 1 << 12
SEED = 20
ROUNDS = 12

# Documents of a source are placed in two steps, ranges of hashes and rows within one.
RANGE_WORDS = 1 << 18
CHUNK_SLOTS = 1 << 12


def trimmed(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\v\f\r"))


def word_count(text: Column) -> Column:
    text = trimmed(text)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, WORD_BREAKS, -1))).cast("long")


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, text, source) -> (doc_id, source, size, hash)."""
    return documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = MIX_SHARE, passes: float = MOST_PASSES) -> DataFrame:
    """(doc_id, source, size) -> (source, source_size, target), a row per source.

    The weights repeat over the sources in code point order. Shares stop at `passes` times the size and the
    excess goes to the others by weight, until none is above: with the sources in the order of
    limit / weight, the first ones stop, and the rest shares what those leave.
    Sources are assumed to fit into one task; their rows are not.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    sources = sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(passes)).alias("most"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    everyone = Window.partitionBy()
    up_to = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sources = sources.select(
        "*",
        (F.sum("source_size").over(everyone) * F.lit(share)).alias("total"),
        F.sum("most").over(up_to).alias("stopped"),
        F.sum("weight").over(from_here).alias("sharing"),
    )
    # What a unit of weight gets if the sources before this one stop and this one shares.
    level = (F.col("total") - (F.col("stopped") - F.col("most"))) / F.col("sharing")
    sources = sources.withColumn("level", F.when(level * F.col("weight") <= F.col("most"), level))
    common = F.max("level").over(everyone)  # the same from the first sharing source on, but for rounding
    target = F.least(F.coalesce(common * F.col("weight"), F.col("most")), F.col("most"))
    return sources.select("source", "source_size", target.alias("target"))


def ranges(sizes: DataFrame, range_words: int = RANGE_WORDS) -> int:
    """How many ranges a source has, by the words of all: one number that comes to the driver."""
    return max(1, -(-(sizes.agg(F.sum("size")).first()[0] or 0) // range_words))


def placed(rows: DataFrame, sizes: DataFrame, places: int) -> DataFrame:
    """(doc_id, source, size, hash, ...) -> the same with `starts`, the number of words of the source before it.

    `rows` and `sizes` are the same documents, without those that have no word. (source, starts) names a document.
    """
    at = F.struct("source", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(places)).alias("place")).alias("at")
    sums = sizes.select(at, "size").groupBy("at").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("at.source").orderBy("at.place").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("at", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("place_starts"))
    before = Window.partitionBy("at").orderBy(F.asc_nulls_first("doc_id"), "size", "hash").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.select("*", at).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return found.join(sums, "at").select(*rows.columns, (F.col("place_starts") + F.col("before")).alias("starts"))


def packed(documents: DataFrame, sizes: DataFrame, places: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text, source) -> (source, block, at_word, doc_id, starts, words): what of a document lies where in which block.

    `words` are the words of the piece, joined by blanks.
    """
    # A filter on the size would split each text once more.
    rows = documents.where(trimmed(F.col("text")) != "")
    rows = rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"), "text")
    rows = placed(rows, sizes.where("size > 0"), places)
    starts, ends = F.col("starts"), F.col("starts") + F.col("size")
    blocks = F.sequence(F.floor(starts / block_words), F.floor((ends - 1) / block_words))

    def piece(parts: Column, block: Column) -> Column:
        first, last = F.greatest(starts, block * block_words), F.least(ends, (block + 1) * block_words)
        own = F.slice(parts, (first - starts + 1).cast("int"), (last - first).cast("int"))
        return F.struct(block.alias("block"), (first - block * block_words).cast("int").alias("at_word"), F.array_join(own, " ").alias("words"))

    # Cut inside the row, so that no row is repeated whole for each of its pieces.
    pieces = bound(F.split(trimmed(F.col("text")), WORD_BREAKS, -1), lambda parts: F.transform(blocks, lambda block: piece(parts, block)))
    found = rows.select("source", "doc_id", "starts", F.explode(pieces).alias("piece"))
    return found.select("source", "piece.block", "piece.at_word", "doc_id", "starts", "piece.words")


def permuted(index: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, chosen by the keys: swap-or-not.

    Each round pairs x with k - x modulo n and swaps the two if a bit, hashed from the larger, says so; so each
    round, and the whole, maps 0..n-1 onto itself, for any n.
    """

    def one_round(x: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(F.lit("key"), r, *keys), n)
        other = F.pmod(k - x, n)
        bit = F.xxhash64(F.lit("bit"), r, F.greatest(x, other), *keys).bitwiseAND(F.lit(1).cast("long"))
        return F.when(bit == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), one_round)


def slots(planned: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(source, source_size, target) -> (shard, slot, source, block), a row per slot of the mix.

    The number of slots of a source is its target in blocks; the last, shorter block counts as what it holds.
    """
    n_blocks = F.ceil(F.col("source_size") / block_words)
    n_slots = F.round(F.col("target") * n_blocks / F.col("source_size")).cast("long")
    plan = planned.where("source_size > 0").select("source", n_blocks.alias("n_blocks"), n_slots.alias("n_slots"))
    shards = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("n_slots").over(Window.partitionBy()) / shard_slots))
    plan = plan.select("*", shards.alias("n_shards")).where("n_slots > 0")
    # A source's slots in chunks, which are dealt over the tasks before they are written out.
    chunks = plan.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_slots") - 1, F.lit(CHUNK_SLOTS))).alias("from"))
    # The number is given, as otherwise so few bytes would be put into one task.
    tasks = int(planned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(tasks, "source", "from")
    dealt = chunks.select(
        "source",
        "n_blocks",
        "n_shards",
        F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK_SLOTS, F.col("n_slots")) - 1)).alias("draw"),
    )
    # The multinomial draw: each of the source's slots goes to a shard of its own accord.
    shard = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "source", "draw"), F.col("n_shards"))
    run = F.floor(F.col("draw") / F.col("n_blocks"))
    index = F.col("draw") % F.col("n_blocks")
    block = permuted(index, F.col("n_blocks"), F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull(), run)
    return dealt.select(shard.alias("shard"), F.col("draw").alias("slot"), "source", block.alias("block"))


def shard_counts(dealt: DataFrame) -> DataFrame:
    """Slots -> (shard, source, n): the counts that were drawn."""
    return dealt.groupBy("shard", "source").agg(F.count("*").alias("n"))


def mixed_pieces(dealt: DataFrame, blocks: DataFrame) -> DataFrame:
    """Slots and packed blocks -> (shard, slot, source, block, at_word, doc_id, starts, words): the mix, written out."""
    key = lambda side: side.withColumn("at", F.struct("source", "block"))
    pieces = key(blocks).drop("source", "block")
    # Sizes of what is generated from a few rows are estimated far too low, so the join is told not to broadcast.
    return key(dealt).hint("merge").join(pieces.hint("merge"), "at").drop("at")


def mixed(documents: DataFrame, sizes: DataFrame, plan: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix of the documents, whose sizes and plan are given."""
    return mixed_pieces(slots(plan, block_words), packed(documents, sizes, ranges(sizes), block_words))


def words_in(words: Column) -> Column:
    """Number of words of a piece, counted in its text."""
    return (F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("long")


def taken(documents: DataFrame) -> DataFrame:
    """(doc_id, text, source) -> (doc_id, size, source_size, target, taken, source), a row per document.

    What is taken of a document is counted in the words that the mix holds of it.
    """
    sizes = kept_as_table(sized(documents))
    plan = targets(sizes)
    mix = mixed(documents, sizes, plan)
    name = F.struct("source", "starts").alias("name")
    took = mix.select(name, words_in(F.col("words")).alias("n")).groupBy("name").agg(F.sum("n").alias("taken"))
    # Documents of which nothing was taken have 0 words in the mix, and so do those without a word.
    with_words = sizes.where("size > 0")
    rows = placed(with_words, with_words, ranges(sizes)).select("doc_id", "size", "source", name)
    rows = rows.hint("merge").join(took.hint("merge"), "name", "left").select("doc_id", "size", "source", F.coalesce("taken", F.lit(0)).alias("taken"))
    rows = rows.union(sizes.where("size = 0").select("doc_id", "size", "source", F.lit(0).cast("long")))
    known = plan.select(F.struct("source").alias("of"), "source_size", "target")
    return rows.withColumn("of", F.struct("source")).join(known, "of").select("doc_id", "size", "source_size", "target", "taken", "source")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix over what the stages before have kept, with its words: (shard, slot, source, block, at_word, doc_id, words)."""
    sizes = kept_as_table(sized(docs))
    return mixed(docs, sizes, targets(sizes)).drop("starts")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: what the mix of `documents` takes of each."""
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
