"""From documents to line records, tokens and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.in_row import partial_counts
from wordloom.functions.stop_patterns import effective, fold_patterns_of_lines, is_literal, remove_patterns
from wordloom.functions.text import (
    ended,
    fold_case,
    split_document,
    split_lines,
    split_tokens,
    whole_document,
    whole_lines,
    whole_tokens,
    with_plain_ends,
)


def normalise(documents: DataFrame, case_sensitive: bool = False, stop_patterns: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text) with case folded and then the stop patterns deleted line by line.

    Documents without a line go. The line structure stays: a last line that loses
    everything is an empty line afterwards.
    """
    rows, literals = prepared(documents, case_sensitive, stop_patterns)
    return rows.withColumn("text", remove_patterns(F.col("text"), literals)) if literals else rows


def prepared(documents: DataFrame, case_sensitive: bool = False, stop_patterns: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The same up to the deletion of literal patterns, and those that are left to delete: for an Arrow pass that does it beside other work."""
    documents = documents.where(F.col("text") != "")
    text = fold_case(F.col("text"), case_sensitive)
    patterns = [p for p in stop_patterns if not set(p) & {"\r", "\n"}]
    if not patterns:
        return documents.withColumn("text", text), []
    # With `\n` between lines no deletion can make one line end of two.
    text = with_plain_ends(ended(text))
    if all(map(is_literal, patterns)):  # cannot match across lines, so one pass over the text
        return documents.withColumn("text", text), effective(patterns)
    stripped = fold_patterns_of_lines(split_lines(text), patterns)
    return documents.withColumn("text", F.array_join(stripped, "\n")), []


def normalise_lines(lines: DataFrame, case_sensitive: bool = False, stop_patterns: Sequence[str] = ()) -> DataFrame:
    """The same for rows that are lines already."""
    return lines.withColumn("line", remove_patterns(fold_case(F.col("line"), case_sensitive), stop_patterns))


def prepared_lines(lines: DataFrame, case_sensitive: bool = False, stop_patterns: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The same, but literal patterns are left to the pass that comes next."""
    if all(map(is_literal, stop_patterns)):
        return normalise_lines(lines, case_sensitive), effective(stop_patterns)
    return normalise_lines(lines, case_sensitive, stop_patterns), []


def line_records(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, line_no, line), line_no from 0."""
    parts = documents.select("doc_id", split_lines(F.col("text")).alias("parts"))
    return parts.select("doc_id", F.posexplode(whole_lines(F.col("parts"))).alias("line_no", "line"))


def token_lines(lines: DataFrame) -> DataFrame:
    """Replace `line` by the array `tokens`."""
    parts = lines.withColumn("parts", split_tokens(F.col("line"))).drop("line")
    return parts.withColumn("tokens", whole_tokens(F.col("parts"))).drop("parts")


def token_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, tokens), the tokens of all lines in one array."""
    parts = documents.select("doc_id", split_document(F.col("text")).alias("parts"))
    return parts.select("doc_id", whole_document(F.col("parts")).alias("tokens"))


def exploded(rows: DataFrame, *keep, name: str = "token") -> DataFrame:
    """One row per token: (*keep, name).

    The outer explode and the filter stand for a plain explode. For that one Spark
    infers a filter on the size of the array and pushes it below whatever computes
    the array, which is then computed twice.
    """
    return rows.select(*keep, F.explode_outer("tokens").alias(name)).where(F.col(name).isNotNull())


def tokens(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) -> (doc_id, line_no, pos, token)."""
    exploded_lines = token_lines(lines).select("doc_id", "line_no", F.posexplode_outer("tokens").alias("pos", "token"))
    return exploded_lines.where("token is not null")


def counted_words(documents: DataFrame, strip: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text) -> (word, n) like `word_counts`, but stripped, split and counted in one Arrow pass over the texts.

    For texts that need a pass anyway; a row per different word and batch goes back. `strip` is what `prepared` has left.
    """
    return partial_counts(documents, strip).groupBy("word").agg(F.sum("n").alias("n"))


def word_counts(rows: DataFrame) -> DataFrame:
    """Rows with a `tokens` array -> (word, n)."""
    return exploded(rows, name="word").groupBy("word").agg(F.count("*").alias("n"))
