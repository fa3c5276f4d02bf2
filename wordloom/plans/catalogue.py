"""The named queries over the table `documents`.

Each is a function of the corpus; `all_queries` reads that once per query and hands it on,
so that a vocabulary and its lookup share the scan.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.in_row import ranked_parts
from wordloom.functions.stop_patterns import application_order
from wordloom.operators import cooccurrence as cooc
from wordloom.operators import frequencies as freq
from wordloom.operators import vocabulary as vocab
from wordloom.operators import words
from wordloom.sources import side_files
from wordloom.sources.corpus import read_table
from wordloom.sources.kept import kept_as_table
from wordloom.sources.writers import sorted_tsv

# Vocabulary sizes, distances, and the corpus size assumed by the idf.
TOP_WORDS = 50
TOP_TERMS = 100
DISTANCES = (1, 2, 3, 4)
ASSUMED_DOCUMENTS = 10_000
# A vocabulary too wide for one array per word, its tiles, and how often a word of a vocabulary without a limit occurs.
WIDE = 1_500
TILE = 400
LEAST_COUNT = 3

# The named vocabularies have at most this many words, whatever the corpus. A word is a run of word characters, which
# junk can make long; where that matters measure with `vocabulary.is_small`.
SMALL = max(TOP_WORDS, TOP_TERMS) <= vocab.LISTED_ROWS

# How many partitions a session wants its corpus dealt out to; by default those of the scan.
PARTITIONS = "wordloom.partitions"

# One pattern a line, blanks at the end matter.
STOP_LIST = Path(__file__).parents[1] / "data" / "stop_list.txt"


def stop_patterns() -> list[str]:
    """The stop list is a parameter; the named queries take the one that comes with the package."""
    return application_order(["", *STOP_LIST.read_text().split("\n")[:-1]])


def documents(corpus: DataFrame, strip: bool = False, case_sensitive: bool = False) -> DataFrame:
    return words.normalise(corpus, case_sensitive, stop_patterns() if strip else ())


def counts(corpus: DataFrame, strip: bool = False, **how) -> DataFrame:
    if strip:
        return words.counted_words(*words.prepared(corpus, stop_patterns=stop_patterns(), **how))
    return words.word_counts(words.token_documents(documents(corpus, **how)))


def top_words(corpus: DataFrame, **how) -> DataFrame:
    return vocab.top_k(counts(corpus, **how), TOP_WORDS)


def lines(corpus: DataFrame, **how) -> DataFrame:
    return words.line_records(documents(corpus, **how))


def token_lines(corpus: DataFrame, **how) -> DataFrame:
    return words.token_lines(lines(corpus, **how))


def token_rows(corpus: DataFrame, **how) -> DataFrame:
    return words.token_documents(documents(corpus, **how))


def doc_terms(corpus: DataFrame, stem=False, **how) -> DataFrame:
    return freq.document_terms(token_rows(corpus, **how), stem=stem)


def doc_freq(corpus: DataFrame, stem=False, strip=False) -> DataFrame:
    rows, left = words.prepared(corpus, stop_patterns=stop_patterns() if strip else ())
    return freq.counted_frequencies(rows, stem, left)


def top_terms(corpus: DataFrame, **how) -> DataFrame:
    return vocab.top_k(doc_freq(corpus, **how), TOP_TERMS, "term", "df")


def ranked_terms(corpus: DataFrame, **how) -> DataFrame:
    return vocab.rank_index(doc_freq(corpus, **how), TOP_TERMS)


def vocab_positions(corpus: DataFrame) -> DataFrame:
    return vocab.in_vocabulary(words.tokens(lines(corpus)), top_words(corpus), small=SMALL).select(
        "doc_id", "line_no", "pos", F.col("token").alias("word")
    )


def cooc_events(corpus: DataFrame, d=2) -> DataFrame:
    return cooc.events(token_lines(corpus), top_words(corpus), d, SMALL, ("doc_id", "line_no"))


def cooc_pairs(corpus: DataFrame, d=1, strip_vocabulary=False) -> DataFrame:
    return cooc.counted_pairs(documents(corpus), top_words(corpus, strip=strip_vocabulary), d)


def many_words(counted: DataFrame) -> DataFrame:
    """A vocabulary that grows with the corpus."""
    return counted.where(F.col("n") >= LEAST_COUNT)


def cooc_pairs_many_words(corpus: DataFrame) -> DataFrame:
    """The words are counted once: the counts are the vocabulary, and name all words that need a number."""
    counted = kept_as_table(counts(corpus))
    return cooc.coded_counts(token_lines(corpus), many_words(counted), 1, words=counted)


def stripes_tiled(corpus: DataFrame) -> DataFrame:
    vocabulary = vocab.top_k(counts(corpus), WIDE)
    directed = cooc.directed_counts(token_lines(corpus), vocabulary, 1, small=WIDE <= vocab.SMALL_ROWS)
    return cooc.tile_text(cooc.tiled_stripes(directed, vocabulary, TILE, small=WIDE <= vocab.SMALL_ROWS))


def top_words_in_rounds(corpus: DataFrame) -> DataFrame:
    return vocab.top_k_in_rounds(ranked_parts(documents(corpus)), TOP_WORDS)


def top_terms_in_rounds(corpus: DataFrame) -> DataFrame:
    best = vocab.top_k_in_rounds(ranked_parts(documents(corpus), by_document=True, stem=True), TOP_TERMS)
    return best.select(F.col("word").alias("term"), F.col("n").alias("df"))


def cooc_pairs_per_line(corpus: DataFrame, d=2) -> DataFrame:
    return cooc.counts_per_row(token_lines(corpus), top_words(corpus), d, keep=("doc_id", "line_no"))


def cooc_directed(corpus: DataFrame, d=2) -> DataFrame:
    return cooc.counted_pairs(documents(corpus), top_words(corpus), d, directed=True)


def cooc_directed_rollup(corpus: DataFrame, d=2) -> DataFrame:
    return cooc.roll_up(cooc.counts_per_row(token_lines(corpus), top_words(corpus), d, directed=True))


def stripes_sparse(corpus: DataFrame, d=2) -> DataFrame:
    vocabulary = top_words(corpus)
    cells = cooc.sparse_stripes(cooc.directed_counts(token_lines(corpus), vocabulary, d, SMALL), vocabulary, SMALL)
    return cells.withColumn("idx", F.col("idx").cast("int"))


def vocab_index(corpus: DataFrame) -> DataFrame:
    """As many words as fit an int."""
    return vocab.lexicographic_index(top_words(corpus), SMALL).withColumn("idx", F.col("idx").cast("int"))


def stripes_dense(corpus: DataFrame, d=1, strip_vocabulary=False) -> DataFrame:
    return cooc.stripe_text(cooc.listed_stripes(documents(corpus), top_words(corpus, strip=strip_vocabulary), d))


def idf(corpus: DataFrame) -> DataFrame:
    return _rounded(freq.idf(top_terms(corpus), freq.document_count(corpus)), "idf")


def tf(corpus: DataFrame, stem=False) -> DataFrame:
    found = freq.term_frequencies(documents(corpus), ranked_terms(corpus, stem=stem), SMALL, stem=stem)
    return found.select("doc_id", "term", "tf")


def tf_cumulative(corpus: DataFrame) -> DataFrame:
    found = freq.term_frequencies(documents(corpus), ranked_terms(corpus), SMALL, running=True)
    return found.select("doc_id", "term", "tf")


def tf_idf(corpus: DataFrame, stem=False) -> DataFrame:
    scores = freq.tf_idf(documents(corpus), ranked_terms(corpus, stem=stem), freq.document_count(corpus), SMALL, stem=stem)
    return _rounded(scores, "tfidf")


def tf_idf_ref_settings(corpus: DataFrame) -> DataFrame:
    """Terms from stripped text, looked up in unstripped text, running counts, fixed N."""
    ranked = ranked_terms(corpus, strip=True, stem=True)
    return _rounded(freq.tf_idf(documents(corpus), ranked, ASSUMED_DOCUMENTS, SMALL, stem=True, running=True), "tfidf")


def stem_dictionary(corpus: DataFrame) -> DataFrame:
    return freq.stem_dictionary(counts(corpus))


def tsv_lines(corpus: DataFrame) -> DataFrame:
    """Lines as a reader of tab-separated files gets them, made of the whole lines of the corpus, their tabs escaped.

    Words repeat as lines do, and some lines are bad.
    """
    word = F.replace("line", F.lit("\t"), F.lit("\\t"))
    value = (
        F.when(F.col("line_no") % 5 == 4, word)
        .when(F.col("line_no") % 7 == 3, F.concat(word, F.lit("\tx")))
        .otherwise(F.concat(word, F.lit("\t"), F.length("line").cast("string")))
    )
    placed = lines(corpus)
    return placed.select(F.lit("corpus").alias("file"), F.col("doc_id").alias("block"), F.col("line_no").alias("row"), value.alias("value"))


def stop_lists_united(corpus: DataFrame) -> DataFrame:
    """Two lists that share every second line: their patterns, and where each is first."""
    one = tsv_lines(corpus)
    other = one.withColumn("value", F.when(F.col("row") % 2 == 0, F.concat("value", F.lit("+"))).otherwise(F.col("value")))
    united = side_files.united_patterns(one, other)
    return united.select("pattern", "first.list", F.col("first.block").alias("doc_id"), F.col("first.row").alias("line_no"))


def _rounded(scores: DataFrame, column: str) -> DataFrame:
    return scores.withColumn(column, F.round(column, 6))


def all_queries() -> dict:
    named = {
        "line_records": lines,
        "lines_stripped": lambda c: lines(c, strip=True),
        "tokens": lambda c: words.tokens(lines(c)),
        "word_count": counts,
        "word_count_case_sensitive": lambda c: counts(c, case_sensitive=True),
        "word_count_stripped": lambda c: counts(c, strip=True),
        "word_count_sorted_tsv": lambda c: sorted_tsv(counts(c)),
        "top50_words": top_words,
        "top50_words_stripped": lambda c: top_words(c, strip=True),
        "vocab_index": vocab_index,
        "vocab_positions": vocab_positions,
        "cooc_events": cooc_events,
        "cooc_pairs_key": lambda c: cooc.pair_keys(cooc_pairs(c)),
        "cooc_pairs_per_line": cooc_pairs_per_line,
        "cooc_pairs_rollup": lambda c: cooc.roll_up(cooc_pairs_per_line(c)),
        "cooc_pairs_ref_vocab": lambda c: cooc_pairs(c, strip_vocabulary=True),
        "cooc_directed": cooc_directed,
        "cooc_directed_rollup": cooc_directed_rollup,
        "stripes_sparse": stripes_sparse,
        "stripes_tiled": stripes_tiled,
        "cooc_pairs_many_words": cooc_pairs_many_words,
        "top50_words_in_rounds": top_words_in_rounds,
        "top100_df_stemmed_in_rounds": top_terms_in_rounds,
        "counts_parsed": lambda c: side_files.parse_word_counts(tsv_lines(c)),
        "vocabulary_parsed": lambda c: side_files.parse_vocabulary(tsv_lines(c)),
        "df_ranks_parsed": lambda c: side_files.parse_document_frequencies(tsv_lines(c)),
        "stop_lists_united": stop_lists_united,
        "stripes_ref_vocab": lambda c: stripes_dense(c, strip_vocabulary=True),
        "doc_terms_distinct": doc_terms,
        "doc_freq": doc_freq,
        "doc_freq_stripped": lambda c: doc_freq(c, strip=True),
        "top100_df": top_terms,
        "df_top_indexed": ranked_terms,
        "idf": idf,
        "tf": tf,
        "tf_cumulative": tf_cumulative,
        "tfidf": tf_idf,
        "stem_dictionary": stem_dictionary,
        "doc_freq_stemmed": lambda c: doc_freq(c, stem=True),
        "top100_df_stemmed": lambda c: top_terms(c, stem=True),
        "top100_df_stripped_stemmed": lambda c: top_terms(c, strip=True, stem=True),
        "tf_stemmed": lambda c: tf(c, stem=True),
        "tfidf_stemmed": lambda c: tf_idf(c, stem=True),
        "tfidf_ref_settings": tf_idf_ref_settings,
    }
    for d in DISTANCES:
        named[f"cooc_pairs_d{d}"] = lambda c, d=d: cooc_pairs(c, d)
        named[f"stripes_dense_d{d}"] = lambda c, d=d: stripes_dense(c, d)
    return {name: _over_documents(query) for name, query in named.items()}


def _over_documents(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        partitions = spark.conf.get(PARTITIONS, None)
        return query(read_table(spark, f"{sf_dir}/documents.parquet", partitions=partitions and int(partitions)))

    return run
