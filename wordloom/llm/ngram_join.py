"""N-gram Jaccard join by grouped prefixes, down to the components of its links.

A document's set holds the distinct runs of `words` words, A-Z in lower case; with fewer words the whole sequence is
its one shingle, and without words the set is empty and linked with nothing. Two documents are linked if
100 * intersection >= `least` * union. The query takes 3 words and 90 %, the pipeline's stage 5 words and 80 %. The steps:

1. Shingles that no other document has can't be in an intersection. They are found first (`common_shingles`) and
   only counted from then on; a document with under `least` % of shared shingles has no link at all.
2. Documents with equal shared shingles and equal size are a class. Its pairs all have the same similarity, so they
   need no comparison. Shingles of one class only count as unshared from here on.
3. Shared shingles are put in the order of their frequency among classes. Linked sets share one in their prefixes, of
   n - ceil(`least` / 100 n) + 1 shingles with the unshared ones first. Classes with identical prefix and size are a group, and only groups
   are joined, on the shingles of their prefixes, filtered by how much is left of either set from there on.
4. In each list of groups with a common shingle, the one with most documents is compared with all others. Groups that
   this has put into one component need no comparison any more; all pairs of others are compared, from the smaller side.
   Group pairs are expanded to their classes and verified on whole sets.

Nothing is left out: a pair is skipped only if it can't be linked or is connected already, which changes no component.
No list is collected, and no pair of equal documents is written. Repeated rows and equal ids are documents by
themselves. Shingles are compared by 54 to 64 bits of their hashes. Columns other than `doc_id` and `text` stay outside.
Rows are numbered by their place in one scan; the stage, which needs them again, writes them with their numbers first.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common_shingles import shared_tokens
from wordloom.llm.components import components
from wordloom.llm.stored import cut, kept_as_table
from wordloom.llm.wordspans import Slice, shingle_hashes, shingle_starts

# Fixed values of the query, and those of the pipeline's stage.
WORDS = 3
LEAST = 90  # per cent
STAGE_WORDS = 5
STAGE_LEAST = 80
PART = 4  # one in so many tokens is looked at first; that is more than what may be unshared


def shingles(s: Slice, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of so many words, or of the whole of a shorter text."""
    hashed = s.word_hashes()
    at = np.flatnonzero(shingle_starts(s.n_words, words))
    text, hashes = [s.text_of_word[at]], [shingle_hashes(hashed, words)[at]]
    for n in range(1, words):
        short = np.flatnonzero(s.n_words == n)
        text.append(short)
        hashes.append(shingle_hashes(hashed, n)[s.first_word[short]] if len(short) else hashed[:0])
    return np.concatenate(text), np.concatenate(hashes)


def _enough(overlap: Column, sizes: Column, least: int) -> Column:
    """Is an overlap enough for two sets with this sum of sizes?"""
    return (100 + least) * overlap >= least * sizes


def _prefix_length(n: Column, least: int) -> Column:
    return n - F.ceil(F.lit(least) * n / 100) + 1


def document_sets(documents: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """(row, doc_id, text) -> (row, doc_id, n, class_id, tokens, one), cut; class and tokens only where a link is possible.

    `one` tells whether documents of the class are linked with each other.
    """
    sets = shared_tokens(documents, partial(shingles, words=words), lower=True)
    possible = (F.col("n") > 0) & (100 * F.size("tokens") >= least * F.col("n"))
    sets = sets.select("row", "doc_id", "n", F.when(possible, F.array_sort("tokens")).alias("tokens"))
    named = F.when(
        F.col("tokens").isNotNull(), F.struct("n", F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(1), "tokens").alias("h2"))
    )
    one = _enough(F.size("tokens"), 2 * F.col("n"), least)
    return cut(sets.select("row", "doc_id", "n", "tokens", named.alias("class"), one.alias("one")))


def classes(sets: DataFrame) -> DataFrame:
    """-> (class, class_id, copies, first_doc, one), a row per class, which is named by its first row."""
    held = sets.where("tokens is not null")
    return held.groupBy("class").agg(
        F.min("row").alias("class_id"), F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"), F.first("one").alias("one")
    )


def _possibly_linked(held: DataFrame, least: int) -> DataFrame:
    """(class_id, n, tokens) without classes of which too much is their own already in a part of the tokens.

    For documents that have copies but nothing similar this saves looking at the rest.
    """
    each = held.select("class_id", F.explode(F.filter("tokens", lambda t: t % PART == 0)).alias("token"))
    own = each.groupBy("token").agg(F.count("*").alias("f"), F.min("class_id").alias("class_id")).where("f = 1")
    own = own.groupBy("class_id").agg(F.count("*").alias("own"))
    shared = F.size("tokens") - F.coalesce("own", F.lit(0))
    return held.join(own, "class_id", "left").where(100 * shared >= least * F.col("n")).select("class_id", "copies", "n", "tokens")


def ordered_sets(sets: DataFrame, known: DataFrame, least: int = LEAST) -> DataFrame:
    """Sets and classes -> (class_id, copies, n, s, tokens, prefix, group): tokens of several classes, rare ones first."""
    held = sets.where("tokens is not null").select(F.col("row").alias("class_id"), "n", "tokens")
    known = cut(_possibly_linked(held.join(known.select("class_id", "copies"), "class_id"), least))
    each = known.select("class_id", F.explode("tokens").alias("token"))
    frequency = each.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    ranked = each.join(frequency, "token").groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("f", "token"))).alias("ranked"))
    sets = known.select("class_id", "copies", "n").join(ranked, "class_id")
    sets = sets.select("class_id", "copies", "n", F.size("ranked").cast("long").alias("s"), F.transform("ranked", lambda r: r["token"]).alias("tokens"))
    sets = sets.where(100 * F.col("s") >= least * F.col("n"))
    length = (_prefix_length(F.col("n"), least) - (F.col("n") - F.col("s"))).cast("int")
    sets = sets.withColumn("prefix", F.slice("tokens", F.lit(1), length))
    group = F.struct("n", "s", F.xxhash64("prefix").alias("h1"), F.xxhash64(F.lit(1), "prefix").alias("h2"))
    return sets.withColumn("group", group)


def postings(sets: DataFrame) -> DataFrame:
    """Ordered sets -> (token, g, n, rest, copies, lead): a row per group and prefix token.

    `g` is the smallest class of the group, `rest` the number of shared tokens from this one on.
    """
    groups = sets.groupBy("group").agg(
        F.min("class_id").alias("g"), F.sum("copies").alias("copies"), F.first("prefix").alias("prefix")
    )
    each = groups.select("g", "copies", "group.n", "group.s", F.posexplode("prefix").alias("i", "token"))
    return each.select("token", "g", "n", (F.col("s") - F.col("i")).alias("rest"), "copies")


def _candidates(left: DataFrame, right: DataFrame, least: int, condition: Column | None = None) -> DataFrame:
    """Postings joined on their token -> distinct group pairs (g1, g2) that the filter leaves, g1 < g2."""
    a = left.select("token", *[F.col(c).alias(f"{c}1") for c in left.columns if c != "token"])
    b = right.select("token", *[F.col(c).alias(f"{c}2") for c in right.columns if c != "token"])
    fits = (F.col("g1") != F.col("g2")) & _enough(F.least("rest1", "rest2"), F.col("n1") + F.col("n2"), least)
    pairs = a.hint("merge").join(b, "token").where(fits if condition is None else fits & condition)
    return pairs.select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Distinct class pairs (a, b) that are linked."""
    x = sets.select(F.col("class_id").alias("a"), F.col("n").alias("n1"), F.col("tokens").alias("t1"))
    y = sets.select(F.col("class_id").alias("b"), F.col("n").alias("n2"), F.col("tokens").alias("t2"))
    both = pairs.join(x, "a").join(y, "b")
    overlap = F.size(F.array_intersect("t1", "t2"))
    return both.where(_enough(overlap, F.col("n1") + F.col("n2"), least)).select("a", "b")


def links(sets: DataFrame, least: int = LEAST) -> DataFrame:
    """Ordered sets (cut) -> (a, b): links between classes that connect all that links connect."""
    lists = postings(sets)
    members = sets.select(F.col("class_id"), F.col("group"))
    groups = members.groupBy("group").agg(F.min("class_id").alias("g"))
    member_of = members.join(groups, "group").select("class_id", "g")

    # The first member of each group against the others, and in each list the group with most documents.
    best = F.max(F.struct("copies", "rest", "g", "n")).alias("best")
    lead = lists.groupBy("token").agg(best).select("token", "best.copies", "best.rest", "best.g", "best.n")
    starred = _candidates(lead, lists, least)
    m = lambda name, of: member_of.select(F.col("class_id").alias(name), F.col("g").alias(of))
    to_lead = starred.join(m("b", "g2"), "g2").select(F.col("g1").alias("a"), "b")
    to_lead = to_lead.union(starred.join(m("b", "g1"), "g1").select(F.col("g2").alias("a"), "b"))
    within = member_of.where("class_id <> g").select(F.col("g").alias("a"), F.col("class_id").alias("b"))
    first = cut(_verified(to_lead.union(within), sets, least))
    roots = components(first)

    # What is still apart: groups with all classes in one component carry it, others stand for themselves.
    rooted = member_of.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
    rooted = cut(rooted.select("class_id", "g", F.coalesce("root", "class_id").alias("root")))
    spread = rooted.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    spread = spread.select("g", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-1 - F.col("g")).alias("part"))
    parted = lists.join(spread, "g")
    sizes = parted.groupBy("token", "part").agg(F.count("*").alias("m"))
    main = sizes.groupBy("token").agg(F.max(F.struct("m", "part")).alias("main"), F.count("*").alias("parts"))
    open_ = parted.join(main.where("parts > 1"), "token").select("token", "g", "n", "rest", "part", (F.col("part") == F.col("main.part")).alias("in_main"))
    apart = F.col("part1") != F.col("part2")
    left = open_.where("not in_main").drop("in_main")
    rest = _candidates(left, open_.drop("in_main"), least, apart)
    mixed = spread.where("part < 0").select(F.col("g").alias("g1"), F.col("g").alias("g2"))
    x = rooted.select(F.col("class_id").alias("a"), F.col("g").alias("g1"), F.col("root").alias("r1"))
    y = rooted.select(F.col("class_id").alias("b"), F.col("g").alias("g2"), F.col("root").alias("r2"))
    expanded = rest.union(mixed).join(x, "g1").join(y, "g2").where((F.col("r1") != F.col("r2")) & (F.col("a") < F.col("b")) | (F.col("g1") != F.col("g2")) & (F.col("r1") != F.col("r2")))
    return first.union(_verified(expanded.select("a", "b"), sets, least))


def joined(documents: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """(row, doc_id, text) -> (row, doc_id, n_shingles, component_id, component), a row per document.

    `component_id` is the smallest id in the component, `component` names it where ids repeat or are null.
    """
    sets = document_sets(documents, words, least)
    known = cut(classes(sets))
    pairs = links(cut(ordered_sets(sets, known, least)), least)
    roots = components(pairs).select(F.col("node").alias("class_id"), "root")
    placed = known.join(roots, "class_id", "left").select(
        "class", "first_doc", F.coalesce("root", F.when(F.col("one") & (F.col("copies") > 1), F.col("class_id"))).alias("root")
    )
    lowest = placed.where("root is not null").groupBy("root").agg(F.min("first_doc").alias("component_id"))
    found = placed.join(lowest, "root").select("class", "root", "component_id")
    rows = sets.join(found, "class", "left")
    lone = F.col("root").isNull()
    return rows.select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("root", "row").alias("component"),
    )


def numbered(documents: DataFrame) -> DataFrame:
    return documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest id, and of those the first row."""
    # The numbers are written with the rows: a second scan may be cut into other partitions, which number them otherwise.
    rows = kept_as_table(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))
    found = joined(rows.select("row", "doc.doc_id", "doc.text"), STAGE_WORDS, STAGE_LEAST)
    known = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")
    kept = found.groupBy("component").agg(F.min(known).alias("kept")).select(F.col("kept.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: (doc_id, n_shingles, component_id) for every row of `documents`."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return joined(numbered(documents)).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT row_no, array_to_string(w[i:i + 2], ' ') AS shingle
    FROM (SELECT row_no, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT row_no, count(*) AS n FROM shingles GROUP BY row_no
), shared AS (
    SELECT x.row_no AS a, y.row_no AS b, count(*) AS n FROM shingles x JOIN shingles y USING (shingle)
    WHERE x.row_no < y.row_no GROUP BY ALL
), linked AS (
    SELECT a, b FROM shared s JOIN sizes x ON x.row_no = a JOIN sizes y ON y.row_no = b WHERE 100 * s.n >= 90 * (x.n + y.n - s.n)
), links AS (
    SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached(a, b) AS (
    SELECT row_no, row_no FROM docs UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM docs d JOIN reached r ON r.a = d.row_no JOIN docs o ON o.row_no = r.b LEFT JOIN sizes s ON s.row_no = d.row_no
GROUP BY d.row_no, d.doc_id
"""
