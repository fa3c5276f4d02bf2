"""Text sinks: tab-separated, in key order where the job asks for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tab_line(*columns: str) -> Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in columns])


def sorted_tsv(counts: DataFrame, key: str = "word", value: str = "n") -> DataFrame:
    """(line) rows `key <tab> value` in binary key order over all partitions."""
    return counts.orderBy(key).select(tab_line(key, value).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write (line) rows as text files; part files keep the order of the partitions."""
    lines.select("line").write.text(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Write `doc <tab> term <tab> score`."""
    write_lines(scores.select(tab_line("doc_id", "term", "tfidf").alias("line")), path)
