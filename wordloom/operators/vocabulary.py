"""Top-k vocabularies, their index, and the lookup of tokens in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wordloom.operators.numbering import numbered
from wordloom.sources.kept import kept_as_table

# What may be called small: a vocabulary up to this size is broadcast, as a filter in
# front of the aggregation. Beyond it, or where nothing is known, counting comes first
# and the lookup shuffles the counted rows.
SMALL_ROWS = 100_000
SMALL_BYTES = 8 << 20

# What may be a list on every worker: rankings whose counts make a dense array per document.
LISTED_ROWS = 1_000
LISTED_BYTES = 64 << 10


def top_k(counts: DataFrame, k: int, word: str = "word", n: str = "n") -> DataFrame:
    """The k rows of highest count; equal counts in word order."""
    return counts.orderBy(F.desc(n), F.asc(word)).limit(k)


def top_k_in_rounds(parts: DataFrame, k: int) -> DataFrame:
    """(part, place, word, n) of `ranked_parts` -> (word, n): `top_k` of the sums, without a shuffle of all words.

    The k first of every part, added up, give a sum that the k-th best word reaches at least. A word that reaches it has the
    mean of it or more in one part; only words that do, and that can still reach it with what they may have in the parts where
    they are below that, are counted over all parts. Parts are written once, as they are read three times.
    """
    parts = kept_as_table(parts)
    m = parts.agg(F.count_distinct("part")).first()[0]
    if not m or k < 1:
        return parts.select("word", "n").limit(0)
    sums = parts.where(F.col("place") < k).groupBy("word").agg(F.sum("n").alias("n"))
    best = sums.orderBy(F.desc("n")).limit(k).agg(F.min("n"), F.count("*")).first()
    bound = best[0] if best[1] == k else 0  # with fewer words all are asked for
    mean = -(-bound // m)
    seen = parts.where(F.col("n") >= mean).groupBy("word").agg(F.sum("n").alias("seen"), F.count("*").alias("in_parts"))
    most = F.col("seen") + (m - F.col("in_parts")) * max(mean - 1, 0)
    candidates = seen.where(most >= bound).select("word")
    counted = parts.join(candidates, "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n"))
    return top_k(counted, k)


def lexicographic_index(vocabulary: DataFrame, small: bool = False) -> DataFrame:
    """(word) -> (word, idx), idx from 0 in word order.

    A `small` vocabulary is numbered in one go. One of any size is cut into ranges of words at places
    taken from a sample; the words of a range are numbered together, whatever they begin with.
    """
    words = vocabulary.select("word").distinct()
    if small:
        return words.select("word", (F.row_number().over(Window.orderBy("word")) - 1).cast("long").alias("idx"))
    return numbered(words, ["word"]).select("word", F.col("place").alias("idx"))


def rank_index(frequencies: DataFrame, k: int) -> DataFrame:
    """(term, df) -> (term, df, idx) of the k most frequent, idx from 0 by falling df."""
    rank = F.row_number().over(Window.orderBy(F.desc("df"), F.asc("term"))) - 1
    return top_k(frequencies, k, "term", "df").select("term", "df", rank.alias("idx"))


def _fits(vocabulary: DataFrame, word: str, most_rows: int, most_bytes: int) -> bool:
    rows, size = (
        vocabulary.limit(most_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum(F.octet_length(word) + 16), F.lit(0)))
        .first()
    )
    return rows <= most_rows and size <= most_bytes


def is_small(vocabulary: DataFrame, word: str = "word") -> bool:
    """May this vocabulary be broadcast? Measures rows and bytes, of a top-k too: a word can be long."""
    return _fits(vocabulary, word, SMALL_ROWS, SMALL_BYTES)


def listed(ranked: DataFrame, word: str = "term") -> list[Row] | None:
    """The rows of a ranking that may go to every worker as one list, measured before it comes; None if it is too large."""
    size = F.octet_length(word)
    # No word leaves its task that is longer than the whole list may be.
    rows = ranked.withColumn("_size", size).withColumn(word, F.when(size <= LISTED_BYTES, F.col(word))).limit(LISTED_ROWS + 1).collect()
    if len(rows) > LISTED_ROWS or sum((r["_size"] or 0) + 16 for r in rows) > LISTED_BYTES:
        return None
    return rows


def is_listed(ranked: DataFrame, word: str = "term") -> bool:
    """May this ranking be a list on every worker?"""
    return _fits(ranked, word, LISTED_ROWS, LISTED_BYTES)


def lookup_side(vocabulary: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(vocabulary) if small else vocabulary


def in_vocabulary(rows: DataFrame, vocabulary: DataFrame, column: str = "token", small: bool = False) -> DataFrame:
    """Keep the rows whose `column` is a word of the vocabulary."""
    return rows.join(lookup_side(vocabulary.select(F.col("word").alias(column)), small), column, "left_semi")
