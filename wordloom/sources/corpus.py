"""Corpora: one row per document, or one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.side_files import kept_lines, numbered_lines


def read_table(
    spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None
) -> DataFrame:
    """Parquet table with one row per document -> (doc_id, text).

    `partitions` deals the rows out anew, which moves every text: for a table of few row groups
    on many cores. Left out, the partitions are those of the scan.
    """
    table = spark.read.parquet(path).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return table if partitions is None else table.repartition(partitions)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Directory of text files, each file one document -> (doc_id, text).

    The file name identifies the document. A file is read whole into one row; for
    files too large for that use `read_lines`.
    """
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Directory of files -> (doc_id), without reading any."""
    return spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("doc_id"))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Directory of text files -> (doc_id, line_no, n_lines, line), also splittable inside large files.

    The files are scanned once; the lines are kept with their places while they are numbered.
    """
    lines = numbered_lines(kept_lines(spark, path), per_file=True)
    name = F.substring_index("file", "/", -1)
    return lines.select(name.alias("doc_id"), F.col("idx").alias("line_no"), "n_lines", F.col("value").alias("line"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Directory of text files -> (doc_id, line), splittable inside large files."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("line"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Directory of text files -> (doc_id, whole, line), the lines of a file block standing together.

    The path identifies the document here. `whole`: the block is the whole file, so no other task has lines of it.
    """
    lines = spark.read.text(path)
    block = F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length"), F.col("_metadata.file_size")
    whole = (block[0] == 0) & (block[1] >= block[2])
    return lines.select(F.col("_metadata.file_path").alias("doc_id"), whole.alias("whole"), F.col("value").alias("line"))
