"""The small text files that go with a corpus: stop lists, vocabularies, word counts.

Reading is in two steps: lines with their place in the files, and what the lines say. The second
takes any table of placed lines (file, block, row, value), whose order is that of the three keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions.stop_patterns import application_order
from wordloom.sources.kept import kept_as_table

PLACE = ("file", "block", "row")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """-> (file, block, row, value). Rows of a block are numbered without gaps."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def kept_lines(spark: SparkSession, path: str) -> DataFrame:
    """Placed lines, written once with their places: a second scan of the files might be cut, and so numbered, in another way."""
    return kept_as_table(placed_lines(spark, path))


def numbered_lines(lines: DataFrame, per_file: bool = False) -> DataFrame:
    """Placed lines -> the same with `idx`, the number of the line from 0, over all files or in each, and `n_lines`.

    The lines are read twice, so their rows have to be numbered already where they are kept (`kept_lines`). A line number is the number of the line in its block plus the lines of the blocks before; only the
    list of blocks is ever sorted as a whole.
    """
    blocks = lines.groupBy("file", "block").agg(F.min("row").alias("first"), F.count("*").alias("size"))
    group = Window.partitionBy("file") if per_file else Window.partitionBy(F.lit(0))
    before = group.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"offset": F.coalesce(F.sum("size").over(before), F.lit(0)), "n_lines": F.sum("size").over(group)})
    idx = F.col("row") - F.col("first") + F.col("offset")
    return lines.join(blocks, ["file", "block"]).select(*lines.columns, idx.alias("idx"), "n_lines")


def united_patterns(*lists: DataFrame) -> DataFrame:
    """Placed lines of several stop lists -> distinct (pattern, first), `first` being its first place."""
    listed = [lines.withColumn("list", F.lit(i)) for i, lines in enumerate(lists)]
    place = F.struct("list", *PLACE)
    return reduce(DataFrame.union, listed).groupBy(F.col("value").alias("pattern")).agg(F.min(place).alias("first"))


def read_stop_patterns(spark: SparkSession, *paths: str) -> list[str]:
    """Union of several stop lists (one pattern per line, blanks kept) in application order.

    A missing file is an error. The list becomes part of the query, so it comes to the driver.
    """
    united = united_patterns(*[placed_lines(spark, path) for path in paths])
    return application_order(row["pattern"] for row in united.orderBy("first").select("pattern").collect())


def _tab_fields(lines: DataFrame) -> DataFrame:
    # Not the CSV reader: it would turn the empty word into null.
    return lines.withColumn("fields", F.split("value", "\t", -1))


def parse_vocabulary(lines: DataFrame) -> DataFrame:
    """First field of each line -> distinct (word)."""
    return _tab_fields(lines).select(F.col("fields")[0].alias("word")).distinct()


def parse_word_counts(lines: DataFrame) -> DataFrame:
    """Placed lines `word <tab> count` -> (word, n); of a repeated word the last line counts.

    Lines with another number of fields, or whose count is no integer, are skipped.
    """
    counted = _tab_fields(lines).where(F.size("fields") == 2)
    counted = counted.select(
        F.col("fields")[0].alias("word"), F.col("fields")[1].try_cast("bigint").alias("n"), F.struct(*PLACE).alias("place")
    )
    return counted.where("n is not null").groupBy("word").agg(F.max_by("n", "place").alias("n"))


def parse_document_frequencies(lines: DataFrame) -> DataFrame:
    """Placed lines `term <tab> df` -> (term, df, idx), idx being the line number from 0.

    Of a repeated term the last line counts. The line of a skipped entry keeps its number.
    """
    entries = _tab_fields(numbered_lines(lines)).where(F.size("fields") >= 2)
    entries = entries.select(F.col("fields")[0].alias("term"), F.col("fields")[1].try_cast("bigint").alias("df"), "idx")
    return entries.where("df is not null").groupBy("term").agg(F.max_by("df", "idx").alias("df"), F.max("idx").alias("idx"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return parse_vocabulary(placed_lines(spark, path))


def read_word_counts(spark: SparkSession, path: str) -> DataFrame:
    return parse_word_counts(placed_lines(spark, path))


def read_document_frequencies(spark: SparkSession, path: str) -> DataFrame:
    return parse_document_frequencies(kept_lines(spark, path))
