"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.stored import cut


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): every node of a link and the smallest node of its component.

    Large-star and small-star steps in turn until the links are stars around the smallest nodes; their number
    grows with the logarithm of the longest path. All steps are aggregations and joins on the nodes; a node with very
    many links is one row where it is counted, and its links are split where they are joined.
    """
    now = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("m"))
        # Large star: every larger neighbour of v is linked with the least around v instead.
        large = now.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "v").select(F.col("u").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # Small star: the smaller neighbours of v, and v, are linked with the least of them.
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
        then = cut(small.select("l.a", "l.b").where("a <> b").distinct())
        if _sum(then) == _sum(now):
            break
        now = then
    roots = then.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(then.select("b", "b").distinct())


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
