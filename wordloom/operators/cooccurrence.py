"""How often words of a vocabulary follow each other within distance d on a line.

Distance counts all tokens of the line, also those outside the vocabulary. An event
is directed: w1 stands before w2.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.in_row import pair_tally, partial_pairs
from wordloom.functions.text import bound
from wordloom.operators.vocabulary import in_vocabulary, lexicographic_index, listed
from wordloom.operators.words import exploded


def followers(lines: DataFrame, d: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a `tokens` array -> one row per token: (*keep, pos, w1, next).

    `next` holds the d tokens after w1, null beyond the end of the line. It is built
    by laying shifted copies of the array side by side; nothing is shuffled.
    """
    n = F.size("tokens")
    shifts = {f"t{j}": F.slice("tokens", F.lit(j + 1), n) for j in range(d + 1)}
    windows = lines.withColumns(shifts)
    windows = windows.select(*keep, F.posexplode(F.arrays_zip(*shifts)).alias("pos", "window"))
    following = F.array(*[F.col("window")[f"t{j}"] for j in range(1, d + 1)])
    return windows.select(*keep, "pos", F.col("window.t0").alias("w1"), following.alias("next"))


def events(
    lines: DataFrame, vocabulary: DataFrame | None, d: int = 1, small: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """-> (*keep, pos1, pos2, w1, w2), one row per co-occurrence event; none for d < 1."""
    first = followers(lines, max(d, 1), keep).where(F.lit(d >= 1))
    if vocabulary is not None:
        first = in_vocabulary(first, vocabulary, "w1", small)
    both = first.select(*keep, "pos", "w1", F.posexplode("next").alias("gap", "w2")).where("w2 is not null")
    if vocabulary is not None:
        both = in_vocabulary(both, vocabulary, "w2", small)
    return both.select(
        *keep, F.col("pos").alias("pos1"), (F.col("pos") + F.col("gap") + 1).alias("pos2"), "w1", "w2"
    )


def directed_counts(
    lines: DataFrame, vocabulary: DataFrame, d: int = 1, small: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """-> (*keep, w1, w2, n).

    With a small vocabulary events are filtered where they arise, so only counted
    vocabulary pairs are shuffled. Otherwise all events are counted first and the
    lookup works on the counts.
    """
    counted = events(lines, vocabulary if small else None, d, small, keep)
    counted = counted.groupBy(*keep, "w1", "w2").agg(F.count("*").alias("n"))
    if small:
        return counted
    return in_vocabulary(in_vocabulary(counted, vocabulary, "w1"), vocabulary, "w2").select(*keep, "w1", "w2", "n")


def pair_counts(
    lines: DataFrame, vocabulary: DataFrame, d: int = 1, small: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """-> (*keep, w1, w2, n) with w1 <= w2: the direction is dropped, before anything is counted."""
    rows = events(lines, vocabulary if small else None, d, small, keep)
    pair = rows.select(*keep, F.least("w1", "w2").alias("w1"), F.greatest("w1", "w2").alias("w2"))
    counted = pair.groupBy(*keep, "w1", "w2").agg(F.count("*").alias("n"))
    if small:
        return counted
    return in_vocabulary(in_vocabulary(counted, vocabulary, "w1"), vocabulary, "w2").select(*keep, "w1", "w2", "n")


# Bits of the code of a word; one is left for words whose codes are not their hashes.
CODE_BITS = 63
MOST_RECODED = 10_000


def different_words(lines: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word) of the lines and the vocabulary, once each: tokens meet in the map-side table, so an exchange moves words, not tokens."""
    return exploded(lines, name="word").union(vocabulary.select("word")).where("word is not null").distinct()


def shared_codes(words: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """Different words -> (code) that two of them or more have."""
    return words.groupBy(hashed(F.col("word")).alias("code")).agg(F.count("*").alias("n")).where("n > 1").select("code")


def word_codes(lines: DataFrame, vocabulary: DataFrame, bits: int = CODE_BITS, words: DataFrame | None = None) -> Callable[[Column], Column]:
    """Word -> number, different for all words of the lines and the vocabulary: a hash, and below 0 for words that share theirs.

    All words are looked at, in one aggregation by code; those that share one are hardly ever any, and are part of the query.
    `words`, where they are known already: rows with a different `word` each, all those of the lines and the vocabulary among them.
    """
    def hashed(word: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(word), 64 - bits)

    words = different_words(lines, vocabulary) if words is None else words.select("word").where("word is not null")
    shared = shared_codes(words, hashed)
    if shared.isEmpty():
        return hashed
    coded = words.select("word", hashed(F.col("word")).alias("code"))
    recoded = [r["word"] for r in coded.join(shared, "code", "left_semi").select("word").limit(MOST_RECODED + 1).collect()]
    if len(recoded) > MOST_RECODED:
        raise ValueError(f"more than {MOST_RECODED} words share {bits} bits")
    places = F.from_json(F.lit(json.dumps(sorted(recoded))), "array<string>")

    def code(word: Column) -> Column:
        place = F.array_position(places, word)
        return F.when(place > 0, -place).otherwise(hashed(word))

    return code


def coded_counts(
    lines: DataFrame, vocabulary: DataFrame, d: int = 1, directed: bool = False, bits: int = CODE_BITS, words: DataFrame | None = None
) -> DataFrame:
    """Lines with `tokens` -> (w1, w2, n), for a vocabulary of any size: equal to `pair_counts` or, directed, `directed_counts`.

    Tokens are numbers before they are paired, so events and counts are two numbers each, however long the words; words come back for
    what is left of the counts after the lookup. `words` is as for `word_codes`, and saves a pass over the lines.
    """
    code = word_codes(lines, vocabulary, bits, words)
    coded = lines.select(F.transform("tokens", code).alias("tokens"))
    rows = events(coded, None, d)
    a, b = F.col("w1"), F.col("w2")
    pair = (a.alias("c1"), b.alias("c2")) if directed else (F.least(a, b).alias("c1"), F.greatest(a, b).alias("c2"))
    counted = rows.select(*pair).groupBy("c1", "c2").agg(F.count("*").alias("n"))
    known = vocabulary.select("word").where("word is not null").distinct()
    side = lambda c, w: known.select(code(F.col("word")).alias(c), F.col("word").alias(w))
    found = counted.join(side("c1", "w1"), "c1").join(side("c2", "w2"), "c2")
    if directed:
        return found.select("w1", "w2", "n")
    return found.select(F.least("w1", "w2").alias("w1"), F.greatest("w1", "w2").alias("w2"), "n")


def known_words(vocabulary: DataFrame) -> list[str]:
    """The words of a vocabulary in order, if it may be a list on every worker; measured before it comes."""
    found = listed(vocabulary.select("word"), "word")
    if found is None:
        raise ValueError("too many words for a list; use `directed_counts` or `pair_counts`")
    return sorted({r["word"] for r in found if r["word"] is not None})  # code points, the order of UTF-8


def _named(pairs: DataFrame, known: list[str], *keep: str) -> DataFrame:
    """(i, j, n) -> (w1, w2, n): places in the list to words."""
    listing = F.from_json(F.lit(json.dumps(known)), "array<string>")
    word = lambda c: F.element_at(listing, F.col(c) + 1)
    return pairs.select(*keep, word("i").alias("w1"), word("j").alias("w2"), "n")


def counts_per_row(
    lines: DataFrame, vocabulary: DataFrame, d: int = 1, directed: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lines with `tokens` -> (*keep, w1, w2, n), counted inside each row: no exchange. For a vocabulary that may be a list.

    With keys that name a row this is `pair_counts`, or `directed_counts`, by row.
    """
    known = known_words(vocabulary)
    words = lines.sparkSession.sparkContext.broadcast(known)
    pairs = pair_tally(F.col("tokens"), words, d, directed)
    return _named(lines.select(*keep, F.inline(pairs)), known, *keep)


def counted_cells(rows: DataFrame, known: list[str], d: int = 1, directed: bool = False) -> DataFrame:
    """(text) of documents, or (line), or (tokens) of lines -> (i, j, n): pairs of the list within distance d, by their places in it.

    One pass splits the texts, looks their tokens up and counts; an exchange adds up at most k * k counts per batch.
    """
    words = rows.sparkSession.sparkContext.broadcast(known)
    return partial_pairs(rows, words, max(d, 0), directed).groupBy("i", "j").agg(F.sum("n").alias("n"))


def counted_pairs(rows: DataFrame, vocabulary: DataFrame, d: int = 1, directed: bool = False) -> DataFrame:
    """The same as (w1, w2, n): equal to `pair_counts` or, directed, `directed_counts` for a vocabulary that may be a list."""
    known = known_words(vocabulary)
    return _named(counted_cells(rows, known, d, directed), known)


def roll_up(counts: DataFrame) -> DataFrame:
    """Counts per line, document or other key -> counts of the corpus."""
    return counts.groupBy("w1", "w2").agg(F.sum("n").alias("n"))


def pair_keys(pairs: DataFrame) -> DataFrame:
    """(w1, w2, n) -> (pair, n) with the pair written `w1,w2`."""
    return pairs.select(F.concat_ws(",", "w1", "w2").alias("pair"), "n")


def sparse_stripes(directed: DataFrame, vocabulary: DataFrame, small: bool = False) -> DataFrame:
    """(w1, w2, n) -> (word, idx, n): the cells of the stripes that are not 0, for any vocabulary."""
    place = lexicographic_index(vocabulary, small).withColumnRenamed("word", "w2")
    return directed.join(place, "w2").select(F.col("w1").alias("word"), "idx", "n")


def _zeros(n: Column) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), n)


def _dense(entries: Column, width: Column) -> Column:
    """Sorted (at, n) -> array of n by place, 0 where there is none."""

    def filled(entries):
        places = F.transform(entries, lambda e: e["at"].cast("int"))
        gaps = F.zip_with(places, F.concat(F.array(F.lit(-1)), places), lambda i, last: i - last - 1)
        cells = F.zip_with(F.slice(gaps, F.lit(1), F.size(entries)), entries, lambda gap, e: F.concat(_zeros(gap), F.array(e["n"])))
        return F.concat(F.flatten(cells), _zeros(width - F.element_at(places, -1) - 1))

    return bound(entries, lambda e: F.when(F.size(e) == 0, _zeros(width)).otherwise(filled(e)))


def stripes(directed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(w1, w2, n) -> (word, stripe): counts for all vocabulary words in word order.

    A stripe is one array as wide as the vocabulary; use it for a vocabulary that may be a list on
    every worker (`vocabulary.is_listed`), and `tiled_stripes` or `sparse_stripes` for others.
    """
    width = vocabulary.agg(F.countDistinct("word").cast("int")).scalar()
    cells = F.array_sort(F.collect_list(F.struct(F.col("idx").alias("at"), "n")))
    grouped = sparse_stripes(directed, vocabulary, small=True).groupBy("word").agg(cells.alias("cells")).withColumn("width", width)
    return grouped.select("word", _dense(F.col("cells"), F.col("width")).alias("stripe"))


def listed_stripes(rows: DataFrame, vocabulary: DataFrame, d: int = 1) -> DataFrame:
    """`stripes` straight from texts or lines, for a vocabulary that may be a list: it is made once and its places are the columns."""
    known = known_words(vocabulary)
    cells = F.array_sort(F.collect_list(F.struct(F.col("j").alias("at"), "n")))
    grouped = counted_cells(rows, known, d, directed=True).groupBy("i").agg(cells.alias("cells"))
    word = F.element_at(F.from_json(F.lit(json.dumps(known)), "array<string>"), F.col("i") + 1)
    return grouped.select(word.alias("word"), _dense(F.col("cells"), F.lit(len(known))).alias("stripe"))


TILE = 1_000


def tiled_stripes(directed: DataFrame, vocabulary: DataFrame, tile: int = TILE, small: bool = False) -> DataFrame:
    """(w1, w2, n) -> (word, tile, cells): dense stripes of a vocabulary of any width, cut into arrays of `tile` columns.

    Every word with a cell has all tiles, the last one may be shorter. No row holds more than a tile, and the rows of a word need not
    meet.
    """
    place = lexicographic_index(vocabulary, small)
    at = F.col("idx")
    cells = directed.join(place.withColumnRenamed("word", "w2"), "w2").select(
        F.col("w1").alias("word"), F.floor(at / tile).cast("int").alias("tile"), (at % tile).cast("int").alias("at"), "n"
    )
    width = place.agg(F.count("*")).scalar()
    # A place before the first one stands for the tile itself, so that tiles of zeros are there too.
    tiles = F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / tile).cast("int")))
    all_tiles = cells.select("word").distinct().withColumn("width", width).select("word", tiles.alias("tile"), F.lit(-1).alias("at"), F.lit(0).cast("long").alias("n"))
    entries = F.filter(F.array_sort(F.collect_list(F.struct("at", "n"))), lambda e: e["at"] >= 0)
    grouped = cells.unionByName(all_tiles).groupBy("word", "tile").agg(entries.alias("entries")).withColumn("width", width)
    own = F.least(F.lit(tile).cast("long"), F.col("width") - F.col("tile").cast("long") * tile).cast("int")
    grouped = grouped.select("word", "tile", "entries", own.alias("own"))
    return grouped.select("word", "tile", _dense(F.col("entries"), F.col("own")).alias("cells"))


def tile_text(tiled: DataFrame) -> DataFrame:
    """(word, tile, cells) -> (word, tile, cells) with the cells written `n0, n1, ...`."""
    return tiled.select("word", "tile", F.array_join(F.transform("cells", lambda n: n.cast("string")), ", ").alias("cells"))


def tiled_stripe_text(tiled: DataFrame) -> DataFrame:
    """-> (word, stripe): the tiles of a word in their order, written as one stripe. Arrays are text before they meet."""
    pieces = F.array_sort(F.collect_list(F.struct("tile", "cells")))
    grouped = tile_text(tiled).groupBy("word").agg(pieces.alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: p["cells"]), ", ")
    return grouped.select("word", F.concat(F.lit("["), joined, F.lit("]")).alias("stripe"))


def stripe_text(dense: DataFrame) -> DataFrame:
    """(word, stripe) -> the stripe written `[n0, n1, ...]`."""
    cells = F.array_join(F.transform("stripe", lambda n: n.cast("string")), ", ")
    return dense.select("word", F.concat(F.lit("["), cells, F.lit("]")).alias("stripe"))
