"""Exact dedup: equal texts by a 128-bit content hash, with the bytes compared inside each group.

Two texts are equal when they are identical after lower-casing A-Z; null counts as empty. Texts are grouped by
two independent 64-bit hashes *and* by their bytes, so that a collision of the hashes makes two classes
instead of one. Copies meet in the map-side hash table first: a text with any number of copies leaves a task once,
with their count and the id that stays. Of the texts only the digest goes further.

What the rows carry to their class is slim: id, hash and digest. Rows that repeat both id and text are folded into one
with a count before, and unfolded behind the join. Classes of more than one in `HOT` of all rows are at most `HOT`; those are broadcast,
and what is left for the shuffle join has no larger key.

`keep` says which row stays: the one with the smallest id, or with the largest. Null ids stay only where a
class has no other, and of rows that repeat the id that stays, one does. An empty table gives no
rows. Only `doc_id` and `text` are read, so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.stored import kept_as_table

# A class is hot if it holds more than one in so many of all rows; so there are at most so many of them.
HOT = 1_000
# Copies of a row are unfolded in two steps of at most so many at once.
UNFOLDED = 4_096

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["a", "b", "text_sha256"]


def folded(text: Column) -> Column:
    """Text with A-Z in lower case, null as empty. Where all is ASCII that is what `lower` does, much faster."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hashed(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, text, a, b) with the text folded and its 128-bit hash."""
    texts = documents.select("doc_id", folded(F.col("text")).alias("text"))
    return texts.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(1), "text")})


def classes(texts: DataFrame, keep: str = "smallest") -> DataFrame:
    """Hashed texts -> (a, b, text_sha256, keep_id, group_size), a row per different text."""
    stays = {"smallest": F.min, "largest": F.max}[keep]("doc_id")
    grouped = texts.groupBy("a", "b", "text").agg(stays.alias("keep_id"), F.count("*").alias("group_size"))
    return grouped.select("a", "b", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")


def members(texts: DataFrame) -> DataFrame:
    """Hashed texts -> (doc_id, a, b, text_sha256, times), repeated rows folded."""
    slim = texts.select("doc_id", "a", "b", F.sha2("text", 256).alias("text_sha256"))
    return slim.groupBy("doc_id", *KEY).agg(F.count("*").alias("times"))


def deduplicated(documents: DataFrame, keep: str = "smallest") -> DataFrame:
    """(doc_id, text) -> (doc_id, keep_id, group_size, kept, text_sha256), a row per document."""
    texts = hashed(documents)
    rows = kept_as_table(members(texts))
    known = kept_as_table(classes(texts, keep))
    total = known.agg(F.sum("group_size")).scalar()
    hot = known.where(F.col("group_size") * HOT > total)
    of_hot = rows.join(F.broadcast(hot), KEY)
    rest = rows.join(F.broadcast(hot.select(KEY)), KEY, "left_anti").join(known.where(F.col("group_size") * HOT <= total), KEY)
    found = of_hot.unionByName(rest)
    # Two steps, so that no array is as long as a row is often.
    first = F.col("batch") * UNFOLDED
    batches = F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / UNFOLDED))
    found = found.select("*", F.explode(batches).alias("batch"))
    found = found.select("*", F.explode(F.sequence(first, F.least("times", first + UNFOLDED) - 1)).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def survivors(documents: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. For tables whose ids differ."""
    return documents.join(decisions.where("kept").select("doc_id"), "doc_id", "left_semi").select(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: (doc_id, keep_id, group_size, kept, text_sha256) for every row of `documents`; the largest id stays."""
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="largest")


SQL = f"""
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t, row_number() OVER () AS r FROM documents
), placed AS (
    SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
        row_number() OVER (PARTITION BY t, doc_id ORDER BY r) AS again
    FROM texts
)
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND again = 1) AS kept, sha256(t) AS text_sha256
FROM placed
"""
