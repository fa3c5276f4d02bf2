"""From raw documents to a training mix: the stages, in order, and how to run them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import decontamination, line_runs, mixing, ngram_join, quality
from wordloom.llm.stored import kept_as_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# (name, stage). All but the last return the columns of documents, with the rows they keep.
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality.stage),
    ("line_dedup", line_runs.stage),
    ("ngram_jaccard_join", ngram_join.stage),
    ("benchmark_decontamination", decontamination.stage),
    ("source_mixing", mixing.stage),
]

# The draws of the last stage hash integers and strings as Spark does, which SQL elsewhere can't repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as a table before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = kept_as_table(docs)
    return docs
