"""Merkle manifest of a dataset: a hash per document, a tree per partition, a root over all, and a proof for each row.

H is the lowercase hex sha256 of its inputs one after the other, digests as hex text. A leaf is H of the fields of
`FIELDS`, each `-` if null, else its byte count, `:` and its value. In a partition, here a language, the leaves stand in the order of
their ids, nulls first, equal ids in the order of their leaves; every `arity` neighbours have H of
them as parent, the last run may be shorter, even one, until one node is left. The same is done with what
is left of the partitions, in the order of their names, null first and UTF-8 bytewise.

A level is made of window functions: where `step` leaves stand below a node, its siblings are `lag` and `lead` columns with the
offsets step, 2 * step, ..., masked by the slot of the node in its run and ended by the end of the run; the row
of a run's first child hashes the parent. A window holds `arity ** levels` leaves, whose subtree ends with them, so a partition of any size
spreads over tasks and a window is bounded; the next tier does the same with the nodes that are left, one per window. What a tier found
travels down by a join of the windows with their parents, as steps (left siblings, right siblings) to the root.

Leaves are written once; of the texts nothing else moves. Rows may repeat: equal rows are
neighbours with leaves of their own. Null ids are never tampered with. An empty table has no root and no rows. Columns beside `FIELDS` may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.stored import kept_as_table
from wordloom.operators.numbering import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
# Levels inside one window.
LEVELS = 10
STEP = "struct<left: string, right: string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """What a field adds to its leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[str] = FIELDS, **changed: Column) -> Column:
    return digest(*[field(changed.get(c, F.col(c))) for c in fields])


def in_tiers(nodes: DataFrame, arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """(key, place, n, h, ...) -> the tiers from the leaves up, each with `window` and `steps`, and (key, h) that is left."""
    tiers = []
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        rows, parents = _tier(nodes, arity, levels)
        tiers.append(rows)
        nodes = kept_as_table(parents)
    return tiers, nodes


def _tier(nodes: DataFrame, arity: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """-> the nodes with the number of their window and the steps in it, and what is left of each window."""
    width = arity**levels
    rows = nodes.withColumn("window", F.floor(F.col("place") / width).cast("long"))
    run = Window.partitionBy("key", "window").orderBy("place")
    to_here = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place, none = F.col("place"), F.lit("")
    rows = rows.withColumn("_node", F.col("h"))
    for i in range(levels):
        step = arity**i
        first, more = place % step == 0, F.col("n") > step  # the row that stands for its node; is there more than one node?
        slot = F.floor(place / step) % arity
        left = [F.coalesce(F.when(slot >= j, F.lag("_node", j * step).over(run)), none) for j in range(arity - 1, 0, -1)]
        right = [F.coalesce(F.when(slot + j < arity, F.lead("_node", j * step).over(run)), none) for j in range(1, arity)]
        rows = rows.withColumns({"_left": F.concat(*left), "_right": F.concat(*right)})
        parent = F.when(more, digest(F.col("_node"), F.col("_right"))).otherwise(F.col("_node"))
        siblings = F.struct(F.col("_left").alias("left"), F.col("_right").alias("right"))
        rows = rows.withColumns({f"_s{i}": F.when(first & more, siblings), "_node": F.when(place % (step * arity) == 0, parent)})
    heads = rows.where(place % width == 0)
    parents = heads.select("key", F.col("window").alias("place"), F.ceil(F.col("n") / width).cast("long").alias("n"), F.col("_node").alias("h"))
    # The siblings of a node stand with its first leaf: for the others that is the last one up to them.
    steps = F.array(*[F.last(f"_s{i}", ignorenulls=True).over(to_here) for i in range(levels)])
    rows = rows.withColumn("steps", F.filter(steps, lambda s: s.isNotNull()))
    return rows.select(*nodes.columns, "window", "steps"), parents


def _down(tiers: list[DataFrame], above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Steps inside the windows, and (key, steps, carried) of what is left -> the leaves with all their steps."""
    above = above.withColumn("place", F.lit(0).cast("long"))
    for rows in reversed(tiers):
        here = above.select("key", F.col("place").alias("window"), F.col("steps").alias("_more"), *carried)
        above = rows.join(here, ["key", "window"]).withColumn("steps", F.concat("steps", "_more")).drop("_more", "window")
    return above


def proven(leaves: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(key, id, h, ...) -> the same with steps, subroot and root: a tree per key, in the order of id and h, and one over the keys."""
    nodes = kept_as_table(numbered(leaves, ["id", "h"], group=["key"]))
    tiers, left = in_tiers(nodes, arity, levels)
    subroots = kept_as_table(left.select(F.col("key").alias("name"), "h"))
    nodes = numbered(subroots, ["name"]).withColumn("key", F.lit(0))
    top_tiers, top = in_tiers(kept_as_table(nodes), arity, levels)
    empty = F.array().cast(f"array<{STEP}>").alias("steps")
    if top_tiers:
        above = _down(top_tiers, top.select("key", empty, F.col("h").alias("root")), ["root"])
        above = above.select(F.col("name").alias("key"), "steps", F.col("h").alias("subroot"), "root")
    else:
        above = nodes.select(F.col("name").alias("key"), empty, F.col("h").alias("subroot"), F.col("h").alias("root"))
    if not tiers:
        return nodes_alone(leaves, above)
    return _down(tiers, above, ["subroot", "root"])


def nodes_alone(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """Where every key has one leaf only, the leaves are the subroots."""
    return leaves.join(above, "key")


def proof_text(steps: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf leads to with these siblings."""
    return F.aggregate(steps, start, lambda h, s: digest(s["left"], h, s["right"]))


def manifest(documents: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """-> (doc_id, leaf, tampered, steps, subroot, root): a row per document, `tampered` null where nothing is changed."""
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(21,0)")
    leaves = documents.select(
        key.alias("key"), F.col("doc_id").alias("id"), leaf().alias("h"), F.when(hit, leaf(n_chars=more)).alias("tampered")
    )
    found = proven(kept_as_table(leaves), arity, levels)
    return found.select(F.col("id").alias("doc_id"), F.col("h").alias("leaf"), "tampered", "steps", "subroot", "root")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the manifest of `documents` with digests of the proofs, and what tampered rows fold to."""
    rows = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("steps")))
    proof = F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _leaf(**changed: str) -> str:
    return "sha256(" + " || ".join(_field(changed.get(c, c)) for c in FIELDS) + ")"


# The fixed value is the reversed polynomial of CRC-32.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

SQL = f"""
WITH RECURSIVE hashed AS (
    SELECT coalesce('=' || lang, '') AS key, doc_id, {_leaf()} AS leaf,
        CASE WHEN n_chars IS NOT NULL AND doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf(n_chars="n_chars::HUGEINT + 1")} END AS tampered
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, row_number() OVER () AS r FROM hashed
), nodes(key, level, place, h) AS (
    SELECT key, 0, place, leaf FROM leaves
    UNION ALL
    SELECT key, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM nodes) WHERE n > 1 GROUP BY key, level, place // 2
), heights AS (
    SELECT key, max(level) AS height FROM nodes GROUP BY key
), subroots AS (
    SELECT key, h, row_number() OVER (ORDER BY key) - 1 AS place FROM nodes JOIN heights USING (key) WHERE level = height
), tops(level, place, h) AS (
    SELECT 0, place, h FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, place // 2
), top_height AS (
    SELECT max(level) AS height FROM tops
), path AS (
    SELECT r, l.level, CASE WHEN (l.place >> l.level) % 2 = 1 THEN s.h ELSE '' END AS before, CASE WHEN (l.place >> l.level) % 2 = 0 THEN coalesce(s.h, '') ELSE '' END AS after
    FROM (SELECT r, key, place, unnest(range(height)) AS level FROM leaves JOIN heights USING (key)) l
    LEFT JOIN nodes s ON s.key = l.key AND s.level = l.level AND s.place = xor(l.place >> l.level, 1)
    UNION ALL
    SELECT r, 1000 + t.level, CASE WHEN (t.place >> t.level) % 2 = 1 THEN s.h ELSE '' END, CASE WHEN (t.place >> t.level) % 2 = 0 THEN coalesce(s.h, '') ELSE '' END
    FROM leaves JOIN (SELECT key, place, unnest(range(height)) AS level FROM subroots, top_height) t USING (key)
    LEFT JOIN tops s ON s.level = t.level AND s.place = xor(t.place >> t.level, 1)
), proofs AS (
    SELECT r, string_agg(before || after, '' ORDER BY level) AS proof, list({{'before': before, 'h': '', 'after': after}} ORDER BY level) AS steps FROM path GROUP BY r
), folded AS (
    SELECT l.*, coalesce(proof, '') AS proof, list_reduce(list_prepend({{'before': '', 'h': coalesce(tampered, leaf), 'after': ''}}, coalesce(steps, [])),
        lambda a, s: {{'before': '', 'h': sha256(s.before || a.h || s.after), 'after': ''}}).h AS folded_root
    FROM leaves l LEFT JOIN proofs USING (r)
)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = t.h AS verified
FROM folded f JOIN subroots s USING (key) CROSS JOIN (SELECT h FROM tops JOIN top_height ON level = height) t
"""
