"""What the executed plans must look like for the work to scale."""

import re

import pytest
from pyspark.sql import functions as F

from wordloom.operators import cooccurrence as cooc
from wordloom.operators import frequencies as freq
from wordloom.operators import vocabulary as vocab
from wordloom.operators import words
from wordloom.plans.catalogue import all_queries

SMALLEST = "/root/testdata/sf0.001"


def executed(df):
    """The plan as run, without the plan before adaptive changes."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"[\r\n]+(?=[,)\r\n])", " ", text)  # line ends inside literals
    kept, indent = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if indent is not None and depth >= indent:
            continue
        indent = None
        if "== Initial Plan ==" in line:
            indent = depth
            continue
        kept.append(line)
    return "\n".join(kept)


@pytest.fixture(scope="module")
def corpus(spark):
    table = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text")
    return words.normalise(table)


def exchanges(plan):
    own = [line for line in plan.splitlines() if "ReusedExchange" not in line]
    return re.findall(r"Exchange hashpartitioning\(([^)]*)", "\n".join(own))


def test_word_count_shuffles_partial_counts_once(corpus):
    plan = executed(words.word_counts(words.token_documents(corpus)))
    assert len(exchanges(plan)) == 1 and "partial_count" in plan
    assert "ReadSchema: struct<text:string>" in plan
    assert plan.count("split(") == 1


def test_top_k_keeps_k_rows_per_task(corpus):
    plan = executed(vocab.top_k(words.word_counts(words.token_documents(corpus)), 50))
    assert "TakeOrderedAndProject(limit=50" in plan


def test_pairs_are_filtered_then_counted_before_the_shuffle(corpus):
    known = vocab.top_k(words.word_counts(words.token_documents(corpus)), 50)
    plan = executed(cooc.pair_counts(words.token_lines(words.line_records(corpus)), known, 4, small=True))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert len(exchanges(plan)) == 2  # one for the vocabulary, one for the pairs
    assert "ReusedExchange" in plan
    lines = plan.splitlines()
    partial = next(i for i, line in enumerate(lines) if "partial_" in line and "w1" in line)
    assert any("BroadcastHashJoin" in line for line in lines[partial:])


@pytest.mark.parametrize("directed", [False, True])
def test_pairs_of_a_listed_vocabulary_are_one_pass(corpus, directed):
    known = vocab.top_k(words.word_counts(words.token_documents(corpus)), 50)
    plan = executed(cooc.counted_pairs(corpus, known, 3, directed))
    assert exchanges(plan) == [exchanges(plan)[0]] and re.match(r"i#\d+, j#\d+", exchanges(plan)[0])
    assert "Join" not in plan and "Generate" not in plan and plan.count("MapInArrow") == 1


def test_pairs_of_a_large_vocabulary_are_shuffled_as_numbers(spark, corpus):
    many = spark.range(0, 200_000).selectExpr("cast(id as string) as word")
    counted = cooc.coded_counts(words.token_lines(words.line_records(corpus)), many, 1)
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(c1#\d+L, c2#\d+L", text)
    below = text.split("Exchange hashpartitioning(c1#", 1)[1]
    assert "partial_count" in below and "cast(" not in below.split("partial_count")[0]


def test_codes_move_words_not_tokens(spark, corpus):
    lines = words.token_lines(words.line_records(corpus))
    known = words.word_counts(words.token_documents(corpus))
    text = cooc.shared_codes(cooc.different_words(lines, known), F.xxhash64)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Join" not in text
    first = text.rsplit("Exchange hashpartitioning(word#", 2)[1]  # of tokens and vocabulary together
    assert "HashAggregate(keys=[word#" in first.split("Union")[0]
    # Known words save the pass over the lines.
    broken = lines.select("doc_id", F.when(F.raise_error(F.lit("read")).isNull(), F.col("tokens")).alias("tokens"))
    code = cooc.word_codes(broken, known, words=known)
    assert known.select(F.count_distinct(code(F.col("word")))).first()[0] == known.count()


def test_large_vocabularies_are_not_broadcast(spark, corpus):
    many = spark.range(0, 2_000_000).selectExpr("cast(id as string) as word")
    plan = cooc.pair_counts(words.token_lines(words.line_records(corpus)), many, 1, small=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text
    lines = text.splitlines()
    join = max(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_count" in line for line in lines[join:])  # counted below the lookup


def test_document_terms_need_no_shuffle_of_their_own(corpus):
    plan = executed(freq.document_frequencies(freq.document_terms(words.token_documents(corpus))))
    assert len(exchanges(plan)) == 1


@pytest.mark.parametrize("stem", [False, True])
@pytest.mark.parametrize("running", [False, True])
def test_counting_terms_is_one_pass_over_the_texts(corpus, stem, running):
    ranked = vocab.rank_index(freq.counted_frequencies(corpus, stem), 100)
    for count in (freq.tf_idf(corpus, ranked, 100, True, stem=stem, running=running), freq.term_frequencies(corpus, ranked, True, stem=stem, running=running)):
        plan = executed(count)
        assert exchanges(plan) == [] and "Join" not in plan and "split(" not in plan
        passes = re.findall(r"ArrowEvalPython \[(.*?)\]", plan)
        # What goes to the pass is the text alone: the ranking comes by itself.
        assert len(passes) == 1 and re.fullmatch(r"plain\((lower\()?text#\d+\)+#\d+", passes[0])


@pytest.mark.parametrize("stem", [False, True])
def test_frequencies_shuffle_partial_counts_only(corpus, stem):
    plan = executed(freq.counted_frequencies(corpus, stem))
    assert exchanges(plan) == [exchanges(plan)[0]] and "term" in exchanges(plan)[0]
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "partial_sum" in plan


def test_tf_queries_take_no_shuffle_beside_the_terms(spark):
    for name in ("tf", "tf_stemmed", "tf_cumulative", "tfidf", "tfidf_stemmed", "tfidf_ref_settings", "cooc_pairs_per_line"):
        plan = executed(all_queries()[name](spark, SMALLEST))
        assert len(exchanges(plan)) <= 1 and "RoundRobin" not in plan, name
    for name in ("cooc_pairs_rollup", "cooc_directed_rollup"):
        assert len(exchanges(executed(all_queries()[name](spark, SMALLEST)))) <= 2, name


def test_no_query_plans_a_cross_join(spark):
    for name, query in all_queries().items():
        plan = query(spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name
        assert "SortMergeJoin" not in plan, name


def test_bucketed_corpora_need_no_shuffle(spark, corpus, tmp_path):
    corpus.write.bucketBy(4, "doc_id").option("path", str(tmp_path / "b")).saveAsTable("bucketed_corpus")
    try:
        bucketed = spark.table("bucketed_corpus")
        known = spark.createDataFrame([("the",), ("of",)], "word string")
        lines = words.token_lines(words.line_records(bucketed))
        plan = executed(cooc.pair_counts(lines, known, 2, True, ("doc_id", "line_no")))
        assert exchanges(plan) == []
        ranked = known.selectExpr("word as term", "1L as df", "0 as idx")
        assert exchanges(executed(freq.term_frequencies(words.token_documents(bucketed), ranked, small=True))) == []
    finally:
        spark.sql("DROP TABLE bucketed_corpus")
