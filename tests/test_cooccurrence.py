"""Pairs and stripes against the worked table, brute force and each other."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.functions import in_row
from wordloom.operators import cooccurrence as cooc
from wordloom.operators import frequencies as freq
from wordloom.operators import vocabulary as vocab
from wordloom.operators import words

TEXTS = (
    "a x b a a",
    "",
    "a\nb\na b\n\na b c a b",
    "b b b b b b b b",
    "...c a, x x b\r\nx\r\n",
)


@pytest.fixture
def known(spark):
    return spark.createDataFrame([("a",), ("b",), ("",), ("zz",)], "word string")


def token_lines(docs, *texts):
    return words.token_lines(words.line_records(words.normalise(docs(*texts))))


def brute(rows, vocabulary, d):
    found = Counter()
    for row in rows:
        t = row["tokens"]
        for i, w1 in enumerate(t):
            for w2 in t[i + 1 : i + 1 + d]:
                if w1 in vocabulary and w2 in vocabulary:
                    found[row["doc_id"], row["line_no"], w1, w2] += 1
    return found


@pytest.mark.parametrize(
    "d, pairs, stripes",
    [
        (1, {"a,a": 1, "a,b": 1}, {"a": "[1, 0]", "b": "[1, 0]"}),
        (2, {"a,a": 1, "a,b": 3}, {"a": "[1, 1]", "b": "[2, 0]"}),
    ],
)
def test_worked_table(spark, docs, d, pairs, stripes):
    ab = spark.createDataFrame([("b",), ("a",)], "word string")
    lines = token_lines(docs, "a x b a a")
    assert {r["pair"]: r["n"] for r in cooc.pair_keys(cooc.pair_counts(lines, ab, d, small=True)).collect()} == pairs
    dense = cooc.stripe_text(cooc.stripes(cooc.directed_counts(lines, ab, d, small=True), ab))
    assert {r["word"]: r["stripe"] for r in dense.collect()} == stripes


@pytest.mark.parametrize("d", [1, 2, 3, 4, 9])
def test_against_brute_force(docs, known, d):
    lines = token_lines(docs, *TEXTS)
    expected = brute(lines.collect(), {"a", "b", "", "zz"}, d)
    rows = cooc.directed_counts(lines, known, d, True, ("doc_id", "line_no")).collect()
    assert {(r["doc_id"], r["line_no"], r["w1"], r["w2"]): r["n"] for r in rows} == expected
    events = cooc.events(lines, known, d, True, ("doc_id", "line_no")).collect()
    assert len(events) == sum(expected.values())
    assert all(1 <= e["pos2"] - e["pos1"] <= d for e in events)


@pytest.mark.parametrize("d", [1, 3])
def test_identities(docs, known, d):
    lines = token_lines(docs, *TEXTS)

    def as_dict(df):
        return {(r["w1"], r["w2"]): r["n"] for r in df.collect()}

    directed = as_dict(cooc.directed_counts(lines, known, d, small=True))
    pairs = as_dict(cooc.pair_counts(lines, known, d, small=True))
    folded = Counter()
    for (w1, w2), n in directed.items():
        folded[min(w1, w2), max(w1, w2)] += n
    assert pairs == folded
    assert as_dict(cooc.roll_up(cooc.pair_counts(lines, known, d, keep=("doc_id", "line_no")))) == pairs
    assert as_dict(cooc.roll_up(cooc.counts_per_row(lines, known, d, keep=("doc_id",)))) == pairs
    assert as_dict(cooc.roll_up(cooc.counts_per_row(lines, known, d, directed=True))) == directed
    assert as_dict(cooc.pair_counts(lines, known, d, small=False)) == pairs
    assert as_dict(cooc.directed_counts(lines, known, d, small=False)) == directed
    wider = as_dict(cooc.pair_counts(lines, known, d + 1))
    assert all(wider[key] >= n for key, n in pairs.items())


def test_stripes_follow_the_vocabulary(docs, known):
    lines = token_lines(docs, *TEXTS)
    dense = {r["word"]: r["stripe"] for r in cooc.stripes(cooc.directed_counts(lines, known, 2), known).collect()}
    assert "zz" not in dense and all(len(v) == 4 for v in dense.values())
    directed = cooc.directed_counts(lines, known, 2)
    assert sum(map(sum, dense.values())) == directed.agg(F.sum("n")).first()[0]
    sparse = {(r["word"], r["idx"]): r["n"] for r in cooc.sparse_stripes(directed, known).collect()}
    assert sparse == {(w, i): n for w, v in dense.items() for i, n in enumerate(v) if n}


@pytest.mark.parametrize("d", [0, -1])
def test_no_distance_no_pairs(docs, known, d):
    lines = token_lines(docs, *TEXTS)
    for small in (True, False):
        assert cooc.pair_counts(lines, known, d, small).count() == 0
        assert cooc.directed_counts(lines, known, d, small).count() == 0
    assert cooc.counts_per_row(lines, known, d).count() == 0


def test_index_of_any_vocabulary(spark):
    names = ["", "a", "aa", "aab", "ab", "b", "\u00e9", "\u4e2d\u6587", "z" * 50, "aa"]
    index = vocab.lexicographic_index(spark.createDataFrame([(w,) for w in names], "word string")).collect()
    assert {r["word"]: r["idx"] for r in index} == {w: i for i, w in enumerate(sorted(set(names), key=str.encode))}


def test_top_k_ties_and_index(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("", 5), ("c", 1)], "word string, n long")
    best = vocab.top_k(counts, 3)
    assert [(r["word"], r["n"]) for r in best.collect()] == [("", 5), ("a", 2), ("b", 2)]
    assert {r["word"]: r["idx"] for r in vocab.lexicographic_index(best).collect()} == {"": 0, "a": 1, "b": 2}
    ranked = vocab.rank_index(best.select(F.col("word").alias("term"), F.col("n").alias("df")), 3)
    assert {r["term"]: r["idx"] for r in ranked.collect()} == {"": 0, "a": 1, "b": 2}


def test_size_of_a_vocabulary_is_measured(spark):
    assert vocab.is_small(spark.createDataFrame([("a",)], "word string"))
    assert vocab.is_small(spark.createDataFrame([], "word string"))
    assert not vocab.is_small(spark.range(vocab.SMALL_ROWS + 1).select(F.col("id").cast("string").alias("word")))
    assert not vocab.is_small(spark.range(1).select(F.repeat(F.lit("x"), vocab.SMALL_BYTES).alias("word")))


def as_dict(df):
    return {(r["w1"], r["w2"]): r["n"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("directed", [False, True])
def test_pairs_counted_in_the_pass_and_by_numbers(docs, spark, seed, directed):
    pick = random.Random(seed)
    texts = ["".join(pick.choices(["a", "b", "c'", "dd", " ", " ", ", ", "\n", "\r\n", "\n\n", "é"], k=pick.randrange(40))) for _ in range(30)]
    corpus = words.normalise(docs(*texts, "", "\n", "a" * 5_000 + " b"))
    lines = words.token_lines(words.line_records(corpus))
    known = spark.createDataFrame([("a",), ("b",), ("",), ("dd",), ("aa",), ("a",), ("a" * 5_000,)], "word string")
    count = cooc.directed_counts if directed else cooc.pair_counts
    for d in (0, 3):
        expected = as_dict(count(lines, known, d, small=True))
        assert as_dict(cooc.counted_pairs(corpus, known, d, directed)) == expected
        assert as_dict(cooc.counted_pairs(lines, known, d, directed)) == expected
        for bits in (63, 2):  # few bits make words share their hash
            assert as_dict(cooc.coded_counts(lines, known, d, directed, bits)) == expected
    dense = {r["word"]: r["stripe"] for r in cooc.stripes(cooc.directed_counts(lines, known, 2), known).collect()}
    assert {r["word"]: r["stripe"] for r in cooc.listed_stripes(corpus, known, 2).collect()} == dense


def test_codes_of_too_many_words_are_an_error(docs, spark, monkeypatch):
    monkeypatch.setattr(cooc, "MOST_RECODED", 2)
    with pytest.raises(ValueError, match="share"):
        cooc.coded_counts(token_lines(docs, "a b c d e f"), spark.createDataFrame([("a",)], "word string"), 1, bits=1)


def test_wide_stripes_are_tiles(spark):
    """20,000 columns in tiles of 1,000; equal to the cells that are not 0."""
    vocabulary = spark.range(20_000).select(F.format_string("w%05d", "id").alias("word"))
    pairs = [(f"w{i:05d}", f"w{(i * 7919 + j * 331) % 20_000:05d}", i + j + 1) for i in (0, 3, 19_999) for j in range(40)] + [("w00003", "w19999", 5), ("w00003", "w00000", 6)]
    directed = spark.createDataFrame(pairs, "w1 string, w2 string, n long").groupBy("w1", "w2").agg(F.sum("n").alias("n"))
    tiled = cooc.tiled_stripes(directed, vocabulary)
    rows = tiled.collect()
    assert {(r["word"], r["tile"]) for r in rows} == {(w, t) for w in ("w00000", "w00003", "w19999") for t in range(20)} and len(rows) == 60
    assert {len(r["cells"]) for r in rows} == {1_000}
    found = {(r["word"], 1_000 * r["tile"] + i): n for r in rows for i, n in enumerate(r["cells"]) if n}
    assert found == {(r["word"], r["idx"]): r["n"] for r in cooc.sparse_stripes(directed, vocabulary).collect()}
    text = {r["word"]: r["stripe"] for r in cooc.tiled_stripe_text(tiled).collect()}
    for word, line in text.items():
        assert [found.get((word, i), 0) for i in range(20_000)] == [int(n) for n in line[1:-1].split(", ")]


def test_tiles_of_any_size_make_the_same_stripe(docs, known):
    directed = cooc.directed_counts(token_lines(docs, *TEXTS), known, 2)
    expected = {r["word"]: r["stripe"] for r in cooc.stripe_text(cooc.stripes(directed, known)).collect()}
    for tile, small in ((1, True), (3, False), (4, True), (1_000, True)):
        text = cooc.tiled_stripe_text(cooc.tiled_stripes(directed, known, tile, small))
        assert {r["word"]: r["stripe"] for r in text.collect()} == expected
    assert cooc.tiled_stripes(directed.where("false"), known).collect() == []


@pytest.mark.parametrize("k", [0, 1, 5, 40, 10_000])
@pytest.mark.parametrize("part_words", [500_000, 20])
def test_top_k_in_rounds(docs, k, part_words, monkeypatch):
    monkeypatch.setattr(in_row, "PART_WORDS", part_words)
    pick = random.Random(k)
    texts = [" ".join(f"w{int(pick.paretovariate(0.7)) % 300}" for _ in range(60)) for _ in range(50)]
    corpus = words.normalise(docs(*texts).repartition(7))
    exact = vocab.top_k(words.word_counts(words.token_documents(corpus)), k)
    found = vocab.top_k_in_rounds(in_row.ranked_parts(corpus), k)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in exact.collect()]
    frequencies = freq.counted_frequencies(corpus, stem=True)
    exact = vocab.top_k(frequencies, k, "term", "df")
    found = vocab.top_k_in_rounds(in_row.ranked_parts(corpus, by_document=True, stem=True), k)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in exact.collect()]


def test_rounds_count_few_words(docs):
    texts = [" ".join(["the of a in"] * 30 + [f"x{i}_{j}" for j in range(200)]) for i in range(40)]
    corpus = words.normalise(docs(*texts).repartition(8))
    found = vocab.top_k_in_rounds(in_row.ranked_parts(corpus), 4)
    plan = found._jdf.queryExecution()
    assert [r["n"] for r in found.collect()] == [1200] * 4
    assert "left_semi" in plan.toString().lower() or "LeftSemi" in plan.toString()
    assert vocab.top_k_in_rounds(in_row.ranked_parts(corpus.where("false")), 4).collect() == []
