"""Numbers in an order, for tables of any size: sort by ranges, number inside each, add what stands before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows looked at per range to place its bounds, and characters of a bound. They decide how even the ranges are, no result.
SAMPLED = 20
BOUND_CHARS = 64


def bounds(rows: DataFrame, order: Sequence[str], ranges: int) -> list[tuple]:
    """At most `ranges - 1` different keys that cut a sample of the rows into even parts; few, so they come to the driver."""
    cut = [F.substring(c, 1, BOUND_CHARS).alias(c) if t == "string" else F.col(c) for c, t in rows.select(*order).dtypes]
    drawn = rows.select(*cut, F.rand(7).alias("_drawn")).orderBy("_drawn").limit(SAMPLED * ranges).select(*order)
    keys = [tuple(r) for r in drawn.orderBy(*order).collect()]
    at = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    return list(dict.fromkeys(at))


def range_number(rows: DataFrame, order: Sequence[str], cuts: Sequence[tuple]) -> Column:
    """In which of the ranges between `cuts` the key of a row lies, from 0. Looks at the square root of the cuts, twice."""
    if not cuts:
        return F.lit(0)
    kinds = dict(rows.select(*order).dtypes)
    entry = lambda values: F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, values)])
    step = max(1, round(len(cuts) ** 0.5))
    listed = lambda some: F.array(*map(entry, some))
    key = F.struct(*order)
    passed = lambda some: F.size(F.filter(some, lambda b: b <= key))
    coarse = passed(listed(cuts[::step]))
    fine = passed(F.slice(listed(cuts), (coarse - 1) * step + 1, F.lit(step)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def numbered(rows: DataFrame, order: Sequence[str], group: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """The rows with `place`, their number from 0 in the order of the keys, nulls first, and `n`, the number of rows.

    With `group` both are by group; a group of any size spreads over the ranges, as the keys begin with it. Columns of `group` are never
    null. Rows with equal keys have an arbitrary order and share a range.
    """
    keys = [*group, *order]
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("_range", range_number(rows, keys, bounds(rows, keys, ranges)).cast("int"))
    sizes = ranged.groupBy("_range", *group).agg(F.count("*").alias("_size"))
    # As many rows as there are ranges and groups.
    of_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "_range", *group, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(of_group).alias("n")
    )
    within = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order)) - 1
    placed = ranged.withColumn("_within", within.cast("long")).join(sizes, ["_range", *group])
    return placed.select(*rows.columns, (F.col("_before") + F.col("_within")).alias("place"), "n")
