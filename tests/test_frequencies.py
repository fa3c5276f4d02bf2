"""Document frequency, term frequency and TF-IDF against brute force."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.operators import frequencies as freq
from wordloom.operators import vocabulary as vocab
from wordloom.operators import words

TEXTS = ("a b a", "b\nb c\n\nb", "", "...", "a running ran\nruns", "\n")


@pytest.fixture
def corpus(docs):
    return words.normalise(docs(*TEXTS))


def line_tokens(corpus):
    found = {}
    for r in words.token_lines(words.line_records(corpus)).orderBy("doc_id", "line_no").collect():
        found.setdefault(r["doc_id"], []).append(r["tokens"])
    return found


def ranked(corpus, k=3):
    terms = freq.document_terms(words.token_documents(corpus))
    return vocab.rank_index(freq.document_frequencies(terms), k)


@pytest.mark.parametrize("stem", [False, True])
def test_document_frequency(corpus, stem):
    from wordloom.functions.porter import porter_stem

    same = porter_stem if stem else str
    expected = Counter()
    for lines in line_tokens(corpus).values():
        expected.update({same(t) for line in lines for t in line})
    by_row = freq.document_terms(words.token_documents(corpus), stem=stem)
    by_line = freq.document_terms(words.token_lines(words.line_records(corpus)), whole_documents=False, stem=stem)
    tokens = words.token_documents(corpus)
    for found in (freq.document_frequencies(by_row), freq.document_frequencies(by_line), freq.counted_frequencies(corpus, stem), freq.counted_frequencies(tokens, stem)):
        assert {r["term"]: r["df"] for r in found.collect()} == expected


@pytest.mark.parametrize("stem", [False, True])
def test_frequencies_of_lines_in_blocks(spark, stem):
    """Files of many sizes, some cut into blocks that stand in any order; batches of three lines."""
    from wordloom.functions.porter import porter_stem

    same = porter_stem if stem else str
    pick = random.Random(5)
    blocks, expected = [], Counter()
    for doc in [*range(40), None]:
        whole = doc is None or pick.random() < 0.6  # parts of one file have its name
        parts = [[" ".join(pick.choices(["run", "runs", "a", "the", "x'y", ""], k=pick.randrange(5))) for _ in range(pick.randrange(6))] for _ in range(1 if whole else 3)]
        tokens = {t for part in parts for line in part for t in re.split(r"[^\w']+", line.rstrip()) if line.strip() or line == ""}
        expected.update({same(t) for t in tokens})
        blocks += [[(None if doc is None else f"f{doc}", whole, line) for line in part] for part in parts]
    pick.shuffle(blocks)
    rows = spark.createDataFrame([row for block in blocks for row in block], "doc_id string, whole boolean, line string").coalesce(1)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, 3)
    try:
        # Neighbouring blocks of one file in one task would be one run; that they are parts is known all the same.
        found = {r["term"]: r["df"] for r in freq.block_frequencies(rows, stem).collect()}
    finally:
        spark.conf.set(limit, before)
    assert found == expected


@pytest.mark.parametrize("running", [False, True])
@pytest.mark.parametrize("stem", [False, True])
def test_texts_count_like_their_tokens(spark, corpus, stem, running):
    top = vocab.rank_index(freq.counted_frequencies(corpus, stem), 4)
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    large = as_rows(freq.term_frequencies(corpus, top, False, stem=stem, running=running))
    assert as_rows(freq.term_frequencies(corpus, top, True, stem=stem, running=running)) == large
    scores = as_rows(freq.tf_idf(corpus, top, 10, False, stem=stem, running=running))
    assert as_rows(freq.tf_idf(corpus, top, 10, True, stem=stem, running=running)) == scores


def test_a_ranking_that_is_too_large_for_a_list_is_joined(spark, corpus, monkeypatch):
    top = ranked(corpus)
    expected = sorted(map(tuple, freq.tf_idf(corpus, top, 10, True).collect()))
    for name, value in (("LISTED_ROWS", 2), ("LISTED_BYTES", 40)):
        monkeypatch.setattr(vocab, name, value)
        assert vocab.listed(top) is None
        assert sorted(map(tuple, freq.tf_idf(corpus, top, 10, True).collect())) == expected
        monkeypatch.undo()


def test_term_frequency(corpus):
    top = ranked(corpus)
    known = {r["term"] for r in top.collect()}
    expected, running = Counter(), Counter()
    for doc, lines in line_tokens(corpus).items():
        for i, line in enumerate(lines):
            for t in line:
                if t in known:
                    expected[doc, t] += 1
                    running[doc, t] += len(lines) - i
    rows = words.token_documents(corpus)
    by_line = words.token_lines(words.line_records(corpus))
    n_lines = {doc: len(lines) for doc, lines in line_tokens(corpus).items()}
    numbered = by_line.withColumn("n_lines", F.create_map(*[F.lit(x) for pair in n_lines.items() for x in pair])[F.col("doc_id")])

    def as_dict(df):
        return {(r["doc_id"], r["term"]): r["tf"] for r in df.collect()}

    for small in (True, False):
        assert as_dict(freq.term_frequencies(by_line, top, small, whole_documents=False)) == expected
        assert as_dict(freq.term_frequencies(freq.weighted_rows(numbered), top, small, whole_documents=False)) == running

    assert as_dict(freq.term_frequencies(rows, top, small=True)) == expected
    assert as_dict(freq.term_frequencies(rows, top, small=False)) == expected
    assert as_dict(freq.term_frequencies(freq.weighted_documents(corpus), top, small=True)) == running
    assert as_dict(freq.term_frequencies(freq.weighted_documents(corpus), top, small=False)) == running


@pytest.mark.parametrize("running", [False, True])
def test_scores_are_dense(corpus, running):
    top = ranked(corpus)
    rows = freq.weighted_documents(corpus) if running else words.token_documents(corpus)
    found = {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"]) for r in freq.tf_idf(rows, top, 10, small=True).collect()}
    large = freq.tf_idf(rows, top, 10, small=False).collect()
    assert {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"]) for r in large} == found
    for small in (True, False):
        sparse = {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"]) for r in freq.sparse_tf_idf(rows, top, 10, small).collect()}
        assert sparse == {key: value for key, value in found.items() if value[0]}
    if not running:
        by_line = words.token_lines(words.line_records(corpus))
        for small in (True, False):
            parts = freq.tf_idf(by_line, top, 10, small, whole_documents=False).collect()
            assert {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"]) for r in parts} == found
    known = {r["term"]: r["df"] for r in top.collect()}
    with_lines = [i for i, t in enumerate(TEXTS) if t]  # also those without tokens
    assert set(found) == {(i, t) for i in with_lines for t in known}
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in freq.term_frequencies(rows, top).collect()}
    for (doc, term), (n, score) in found.items():
        assert n == tf.get((doc, term), 0)
        assert score == pytest.approx(n * math.log(10 / (1 + known[term])))


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("whole", [True, False])
def test_rankings_with_gaps_and_empty_ones(spark, corpus, small, whole):
    rows = words.token_documents(corpus)
    gaps = spark.createDataFrame([("b", 2, 1), ("zz", 1, 4)], "term string, df long, idx long")
    found = freq.tf_idf(rows, gaps, 10, small, whole).collect()
    assert len(found) == 2 * sum(1 for t in TEXTS if t)
    assert sorted((r["doc_id"], r["tf"]) for r in found if r["tf"]) == [(0, 1), (1, 3)]
    assert freq.tf_idf(rows, gaps.where("false"), 10, small, whole).count() == 0


def test_running_counts_equal_plain_ones_on_one_line(docs):
    corpus = words.normalise(docs("a b a", "b c\n"))
    top = ranked(corpus)
    plain = freq.tf_idf(words.token_documents(corpus), top, freq.document_count(corpus), True)
    assert plain.exceptAll(freq.tf_idf(freq.weighted_documents(corpus), top, freq.document_count(corpus), True)).count() == 0
