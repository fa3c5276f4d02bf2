"""The parts that operators share: words and hashes, indexes, permutations, components."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.llm import crf, fm_index, mixing
from wordloom.llm.stored import cut
from wordloom.llm.common_shingles import _pressed, _unpressed
from wordloom.llm.components import components
from wordloom.llm.wordspans import U64, shingle_hashes, shingle_starts, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é中 \t\n\x0b\u00a0", max_size=12)), max_size=8), st.integers(1, 30))
def test_words_of_texts(texts, limit):
    known, seen = {}, 0
    for s in slices(pa.array(texts, pa.string()), limit=limit):
        words = [WORD.findall(t or "") for t in texts[s.first : s.first + s.n]]
        assert s.n_words.tolist() == [len(w) for w in words]
        for word, h in zip(itertools.chain(*words), s.word_hashes().tolist()):
            assert known.setdefault(word, h) == h
        seen += s.n
        starts = shingle_starts(s.n_words, 3)
        assert starts.sum() == sum(max(0, len(w) - 2) for w in words)
    assert seen == len(texts) and len(set(known.values())) == len(known)


def test_shingles_depend_on_order():
    a, b, c = (np.array([x], U64) for x in (1, 2, 3))
    both = [shingle_hashes(np.concatenate(x), 3)[0] for x in itertools.permutations([a, b, c])]
    assert len(set(both)) == 6


def test_packed_values_come_back():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 40, 1000).astype(U64)
    documents = np.sort(rng.integers(0, 1 << 16, 1000))
    found = _unpressed(_pressed(values, documents))
    assert (found[0] == values).all() and (found[1] == documents).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=3, max_size=60), st.integers(1, 3))
def test_backward_search(symbols, length):
    text = np.array([*symbols, 0])
    index = fm_index.FMIndex(text, 5)
    assert [tuple(text[i:]) for i in index.suffixes] == sorted(tuple(text[i:]) for i in range(len(text)))
    patterns = np.array(list(itertools.product(range(1, 5), repeat=length)))
    start, stop = index.intervals([patterns[:, j] for j in range(length)])
    for pattern, a, b in zip(patterns, start, stop):
        there = {i for i in range(len(symbols) - length + 1) if symbols[i : i + length] == pattern.tolist()}
        assert set(index.suffixes[a:b].tolist()) == there


def test_range_minima():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 100, 50)
    start = rng.integers(0, 49, 200)
    stop = start + 1 + rng.integers(0, 50 - start)
    assert fm_index.range_minima(values, start, stop).tolist() == [values[a:b].min() for a, b in zip(start, stop)]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1001])
def test_permutations(spark, n):
    ids = spark.range(n).select(*[mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(k)).alias(f"p{k}") for k in range(2)])
    rows = ids.collect()
    for k in range(2):
        assert sorted(r[k] for r in rows) == list(range(n))
    if n > 60:
        assert [r[0] for r in rows] != [r[1] for r in rows]


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200)]
    links += [(300, 301 + i) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in found} == {x: find(x) for x in linked} and len(found) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5):
        model = crf.Model(rng.normal(size=crf.DIMENSIONS), rng.normal(size=(2, 2)))
        features = [[int(f) for f in rng.integers(1, crf.DIMENSIONS, 3)] for _ in range(n)]
        scores = model.scores(features)

        def value(y):
            return sum(s for s, label in zip(scores, y) if label) + sum(model.edges[a, b] for a, b in zip(y, y[1:]))

        assert model.decode(features) == list(max(itertools.product((0, 1), repeat=n), key=value))
    assert model.decode([]) == []


def test_the_field_learns_transitions():
    # Labels alternate; only the first block of a page can be told by its features.
    pages = [([[10 + first], *[[5]] * 5], [(first + i) % 2 for i in range(6)]) for first in (0, 1) for _ in range(4)]
    model = crf.fit(pages)
    for features, labels in pages:
        assert model.decode(features) == labels


def test_a_cut_keeps_the_partitions_of_its_scan(spark):
    rows = spark.range(0, 1000, 1, 57)
    assert cut(rows).rdd.getNumPartitions() == 57
    assert cut(rows).count() == 1000
