"""Document frequency, term frequency and TF-IDF."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wordloom.functions.in_row import partial_frequencies, term_tally
from wordloom.functions.porter import stems_udf
from wordloom.functions.text import split_lines, split_tokens, whole_lines, whole_tokens
from wordloom.operators.vocabulary import listed, lookup_side
from wordloom.operators.words import exploded, token_documents


def stemmed(rows: DataFrame) -> DataFrame:
    """Replace the `tokens` array by the array of Porter stems."""
    return rows.withColumn("tokens", stems_udf()("tokens"))


def stem_dictionary(words: DataFrame) -> DataFrame:
    """Distinct (word) -> (token, stem)."""
    stem = F.element_at(stems_udf()(F.array("word")), 1)
    return words.select(F.col("word").alias("token"), stem.alias("stem"))


def document_terms(rows: DataFrame, whole_documents: bool = True, stem: bool = False) -> DataFrame:
    """(doc_id, tokens) -> distinct (doc_id, term).

    Where each row is a whole document its distinct terms are found inside the row and
    nothing is shuffled. Rows that are parts of documents need a `distinct` as well.
    """
    rows = rows.select("doc_id", F.array_distinct("tokens").alias("tokens"))
    if stem:
        rows = stemmed(rows).withColumn("tokens", F.array_distinct("tokens"))
    terms = exploded(rows, "doc_id", name="term")
    return terms if whole_documents else terms.distinct()


def document_frequencies(terms: DataFrame) -> DataFrame:
    """Distinct (doc_id, term) -> (term, df)."""
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def counted_frequencies(rows: DataFrame, stem: bool = False, strip: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text), a row per document -> (term, df): one pass strips, splits, stems and counts, and only partial counts travel."""
    return partial_frequencies(rows, stem, strip=strip).groupBy("term").agg(F.sum("df").alias("df"))


def block_frequencies(rows: DataFrame, stem: bool = False, strip: Sequence[str] = ()) -> DataFrame:
    """(doc_id, whole, line), the lines of files as they stand in them -> (term, df).

    A file that is one block is counted in its task. Of a file that is cut into several blocks each block gives its terms once, and
    those meet by file and term.
    """
    # Read once: the ids tell the two kinds apart, and a missing id stands for itself in the first sum.
    found = partial_frequencies(rows, stem, False, strip).groupBy("doc_id", "term").agg(F.sum("df").alias("df"))
    once = F.when(F.col("doc_id").isNull(), F.col("df")).otherwise(1)
    return found.groupBy("term").agg(F.sum(once).alias("df"))


def weighted_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, tokens, weights), a token weighing n_lines - line_no.

    The weight of a token is the number of lines from its own to the last one: what a
    running count amounts to that is reported after every line and then summed.
    """
    lines = documents.select("doc_id", whole_lines(split_lines(F.col("text"))).alias("lines"))
    split = F.transform("lines", lambda line: whole_tokens(split_tokens(line)))
    rows = lines.select("doc_id", F.size("lines").alias("n_lines"), split.alias("by_line"))
    weights = F.transform("by_line", lambda t, i: F.array_repeat((F.col("n_lines") - i).cast("long"), F.size(t)))
    return rows.select("doc_id", F.flatten("by_line").alias("tokens"), F.flatten(weights).alias("weights"))


def weighted_rows(numbered: DataFrame) -> DataFrame:
    """(doc_id, line_no, n_lines, tokens), a row per line -> (doc_id, tokens, weights) by the same weights."""
    weight = (F.col("n_lines") - F.col("line_no")).cast("long")
    return numbered.select("doc_id", "tokens", F.array_repeat(weight, F.size("tokens")).alias("weights"))


def _hits(rows: DataFrame) -> DataFrame:
    """-> (doc_id, term, weight), a row per token."""
    if "weights" not in rows.columns:
        return exploded(rows, "doc_id", F.lit(1).cast("long").alias("weight"), name="term")
    each = rows.select("doc_id", F.explode_outer(F.arrays_zip("tokens", "weights")).alias("t"))
    return each.where("t.tokens is not null").select("doc_id", F.col("t.tokens").alias("term"), F.col("t.weights").alias("weight"))


def _known(ranked: DataFrame) -> list[Row] | None:
    """The ranking by index where it may be a list on every worker."""
    found = listed(ranked)
    return None if found is None else sorted(found, key=lambda r: r["idx"])


def _tally(rows: DataFrame, known: list[Row], stem: bool, dense: bool, running: bool) -> Column:
    terms = rows.sparkSession.sparkContext.broadcast([r["term"] for r in known])
    return term_tally(rows, terms, stem, dense, running)


def _tokenised(rows: DataFrame, stem: bool, running: bool) -> DataFrame:
    """Rows with tokens, in the JVM, for what has to be exploded."""
    if "text" in rows.columns:
        rows = weighted_documents(rows) if running else token_documents(rows)
    return stemmed(rows) if stem else rows


def _listing(known: list[Row], *columns: str) -> Column:
    """Array of what belongs to each index, a literal of the plan: one expression, however many there are."""
    kinds = {"term": "string", "idx": "int", "idf": "double"}
    entries = json.dumps([{c: r[c] for c in columns} for r in known])
    return F.from_json(F.lit(entries), f"array<struct<{', '.join(f'{c}: {kinds[c]}' for c in columns)}>>")


def _nothing(rows: DataFrame, schema: str) -> DataFrame:
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.sparkSession.createDataFrame([], f"doc_id {id_type}, {schema}")


def term_frequencies(
    rows: DataFrame, ranked: DataFrame, small: bool = False, whole_documents: bool = True, stem: bool = False, running: bool = False
) -> DataFrame:
    """Rows and (term, df, idx) -> (doc_id, term, idx, tf), tf > 0.

    Rows are documents (doc_id, text), or have an array `tokens` and perhaps `weights`. `small`: the ranking is measured, and if it may be a list on
    every worker it is made once and sent there; then one pass splits, stems and counts, and needs no exchange.
    Rows that are parts of documents are added up. `stem`: terms are stems, and the stems of the tokens are counted.
    `running`, for texts: a token weighs as many as there are lines from its own to the last one.
    """
    known = _known(ranked) if small else None
    if known is None:
        counted = _hits(_tokenised(rows, stem, running)).groupBy("doc_id", "term").agg(F.sum("weight").alias("tf"))
        return counted.join(ranked.select("term", "idx"), "term").select("doc_id", "term", "idx", "tf")
    if not known:
        return _nothing(rows, "term string, idx int, tf long")
    found = _hits_listed(rows, known, stem, running)
    if not whole_documents:
        found = found.groupBy("doc_id", "at").agg(F.sum("tf").alias("tf"))
    return found.select("doc_id", _entry(known, "term", "idx").alias("r"), "tf").select("doc_id", "r.term", "r.idx", "tf")


def _hits_listed(rows: DataFrame, known: list[Row], stem: bool, running: bool) -> DataFrame:
    """-> (doc_id, at, tf), `at` being the place in the list, for what occurs."""
    hits = rows.select("doc_id", F.explode(_tally(rows, known, stem, False, running)).alias("hit"))
    return hits.select("doc_id", F.col("hit.idx").alias("at"), "hit.tf")


def _entry(known: list[Row], *columns: str) -> Column:
    return F.element_at(_listing(known, *columns), F.col("at") + 1)


def _completed(rows: DataFrame, ranked: DataFrame, whole_documents: bool, stem: bool, running: bool) -> DataFrame:
    """-> (doc_id, idx, tf) for every document and index up to the last: zeros, added up with what is found."""
    indices = F.sequence(F.lit(0).cast("long"), ranked.agg(F.max("idx").cast("long")).scalar())
    documents = rows.select("doc_id") if whole_documents else rows.select("doc_id").distinct()
    zeros = documents.select("doc_id", F.explode(indices).alias("idx"), F.lit(0).cast("long").alias("tf"))
    found = term_frequencies(rows, ranked, False, whole_documents, stem, running).select("doc_id", F.col("idx").cast("long").alias("idx"), "tf")
    return zeros.union(found).groupBy("doc_id", "idx").agg(F.sum("tf").alias("tf"))


def idf(frequencies: DataFrame, n_docs: int | Column) -> DataFrame:
    """(term, df) -> (term, df, idf) with idf = ln(n_docs / (1 + df)), which may be negative."""
    n = F.lit(n_docs).cast("double")
    return frequencies.withColumn("idf", F.log(n / (F.col("df") + 1)))


def tf_idf(
    rows: DataFrame,
    ranked: DataFrame,
    n_docs: int | Column,
    small: bool = False,
    whole_documents: bool = True,
    stem: bool = False,
    running: bool = False,
) -> DataFrame:
    """-> (doc_id, term, tf, tfidf) for every document and ranked term; an empty ranking gives none.

    The result is dense, documents times terms; for a long ranking multiply `sparse_tf_idf` instead.
    Rows, `small`, `stem` and `running` are as for `term_frequencies`.
    """
    scored = idf(ranked, n_docs)
    known = _known(scored) if small else None
    if known is None:
        at = scored.select(F.col("idx").cast("long").alias("idx"), "term", "idf")
        # Indices may have gaps; the join leaves those out.
        scores = _completed(rows, ranked, whole_documents, stem, running).join(at, "idx")
    elif not known:
        return _nothing(rows, "term string, tf long, tfidf double")
    elif whole_documents:
        counts = rows.select("doc_id", _tally(rows, known, stem, True, running).alias("tfs"))
        pairs = F.zip_with(_listing(known, "term", "idf"), "tfs", lambda r, n: F.struct(r["term"].alias("term"), r["idf"].alias("idf"), n.alias("tf")))
        scores = counts.select("doc_id", F.inline(pairs))
    else:
        places = F.explode(F.sequence(F.lit(0), F.lit(len(known) - 1)))
        zeros = rows.select("doc_id").distinct().select("doc_id", places.alias("at"), F.lit(0).cast("long").alias("tf"))
        counts = zeros.union(_hits_listed(rows, known, stem, running)).groupBy("doc_id", "at").agg(F.sum("tf").alias("tf"))
        scores = counts.select("doc_id", _entry(known, "term", "idf").alias("r"), "tf").select("doc_id", "r.term", "r.idf", "tf")
    return scores.select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def sparse_tf_idf(
    rows: DataFrame,
    ranked: DataFrame,
    n_docs: int | Column,
    small: bool = False,
    whole_documents: bool = True,
    stem: bool = False,
    running: bool = False,
) -> DataFrame:
    """The same without the rows whose tf is 0, for a ranking of any length."""
    found = term_frequencies(rows, ranked, small, whole_documents, stem, running).select("doc_id", "term", "tf")
    scores = found.join(lookup_side(idf(ranked, n_docs).select("term", "idf"), small), "term")
    return scores.select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def document_count(documents: DataFrame) -> Column:
    """Number of documents, as a scalar sub-query."""
    return documents.agg(F.count("*")).scalar()
