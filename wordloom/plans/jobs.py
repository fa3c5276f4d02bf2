"""Whole jobs from input path to output path, to be chained through their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wordloom.operators import cooccurrence as cooc
from wordloom.operators import frequencies as freq
from wordloom.operators import vocabulary as vocab
from wordloom.operators import words
from wordloom.sources.corpus import read_blocks, read_lines, read_names, read_numbered_lines
from wordloom.sources.side_files import (
    read_document_frequencies,
    read_stop_patterns,
    read_vocabulary,
    read_word_counts,
)
from wordloom.sources.writers import sorted_tsv, tab_line, write_lines, write_scores


def _token_lines(
    spark: SparkSession, corpus: str, stop_files: Sequence[str], case_sensitive: bool, numbered: bool = False
) -> DataFrame:
    patterns = read_stop_patterns(spark, *stop_files) if stop_files else []
    lines = read_numbered_lines(spark, corpus) if numbered else read_lines(spark, corpus)
    return words.token_lines(words.normalise_lines(lines, case_sensitive, patterns))


def word_count(spark, corpus: str, output: str, stop_files: Sequence[str] = (), case_sensitive: bool = False) -> None:
    """`word <tab> n` in word order."""
    counts = words.word_counts(_token_lines(spark, corpus, stop_files, case_sensitive))
    write_lines(sorted_tsv(counts), output)


def top(spark, counts: str, output: str, k: int = 50) -> None:
    """The k lines of highest count of a word count or document frequency output."""
    best = vocab.top_k(read_word_counts(spark, counts), k)
    write_lines(best.select(tab_line("word", "n").alias("line")), output)


def pairs(
    spark, corpus: str, vocabulary: str, output: str, d: int = 1, stop_files: Sequence[str] = (), case_sensitive: bool = False
) -> None:
    """`w1,w2 <tab> n` in key order."""
    known = read_vocabulary(spark, vocabulary)
    counted = _counted(_token_lines(spark, corpus, stop_files, case_sensitive), known, d, directed=False)
    write_lines(sorted_tsv(cooc.pair_keys(counted), "pair"), output)


def _counted(lines: DataFrame, known: DataFrame, d: int, directed: bool) -> DataFrame:
    """By the size of the vocabulary: a list on every worker, a broadcast filter, or numbers for words."""
    if vocab.is_listed(known, "word"):
        return cooc.counted_pairs(lines, known, d, directed)
    if vocab.is_small(known):
        return (cooc.directed_counts if directed else cooc.pair_counts)(lines, known, d, small=True)
    return cooc.coded_counts(lines, known, d, directed)


def stripes(
    spark, corpus: str, vocabulary: str, output: str, d: int = 1, sparse: bool = False,
    stop_files: Sequence[str] = (), case_sensitive: bool = False
) -> None:
    """`word <tab> [n0, n1, ...]` in word order; or, `sparse`, `word <tab> idx <tab> n` for the cells that are not 0.

    Dense stripes of a wide vocabulary are made of tiles.
    """
    known = read_vocabulary(spark, vocabulary)
    lines = _token_lines(spark, corpus, stop_files, case_sensitive)
    if not sparse and vocab.is_listed(known, "word"):
        text = cooc.stripe_text(cooc.listed_stripes(lines, known, d))
    else:
        small = vocab.is_small(known)
        directed = _counted(lines, known, d, directed=True)
        if sparse:
            cells = cooc.sparse_stripes(directed, known, small).orderBy("word", "idx")
            write_lines(cells.select(tab_line("word", "idx", "n").alias("line")), output)
            return
        text = cooc.tiled_stripe_text(cooc.tiled_stripes(directed, known, small=small))
    write_lines(sorted_tsv(text, "word", "stripe"), output)


def document_frequency(
    spark, corpus: str, output: str, stop_files: Sequence[str] = (), case_sensitive: bool = False, stem: bool = True
) -> None:
    """`term <tab> df` in term order; each file of the corpus is a document, read line by line.

    Terms are counted where the block of a file is read; files that are one block need no exchange but that of the counts.
    """
    patterns = read_stop_patterns(spark, *stop_files) if stop_files else []
    rows, left = words.prepared_lines(read_blocks(spark, corpus), case_sensitive, patterns)
    write_lines(sorted_tsv(freq.block_frequencies(rows, stem, left), "term", "df"), output)


def tf_idf(
    spark,
    corpus: str,
    frequencies: str,
    output: str,
    n_docs: int | None = None,
    running: bool = False,
    sparse: bool = False,
    stop_files: Sequence[str] = (),
    case_sensitive: bool = False,
    stem: bool = True,
) -> None:
    """`doc <tab> term <tab> score` for every document and every line of `frequencies`.

    `n_docs` is the corpus size in the idf, by default that of this corpus. `running`
    weighs the tokens of a line by the number of lines from there to the end. `sparse` leaves out zeros.
    """
    rows = _token_lines(spark, corpus, stop_files, case_sensitive, numbered=running)
    rows = freq.weighted_rows(rows) if running else rows
    ranked = read_document_frequencies(spark, frequencies)
    if n_docs is None:
        n_docs = freq.document_count(read_names(spark, corpus))
    score = freq.sparse_tf_idf if sparse else freq.tf_idf
    write_scores(score(rows, ranked, n_docs, small=True, whole_documents=False, stem=stem), output)
