"""The tokenizer of the Arrow passes against the rules line by line."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from wordloom.functions import in_row
from wordloom.functions.batch_tokens import slice_bounds, sliced, text_tokens
from wordloom.operators import words


def lines_of(text):
    parts = re.split(r"\r\n|\r|\n", text)
    return parts[:-1] if parts[-1] == "" else parts


def tokens_of(line):
    if line == "":
        return [""]
    parts = re.split(r"[^A-Za-z0-9_']+", line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def drawn(seed, most=9):
    pick = random.Random(seed)
    texts = ["".join(pick.choices("ab'_ \r\n,é€9", k=pick.randrange(most))) for _ in range(pick.randrange(6))]
    return [None if pick.random() < 0.1 else t for t in texts]


def test_texts_and_lines():
    for seed in range(400):
        check_tokens(drawn(seed))


def check_tokens(texts):
    expected, weighted = Counter(), Counter()
    for row, text in enumerate(texts):
        lines = lines_of(text) if text else []
        for i, line in enumerate(lines):
            for token in tokens_of(line):
                expected[row, token] += 1
                weighted[row, token] += len(lines) - i
    found = text_tokens(pa.array(texts, pa.string()), weights=True)
    listed = list(zip(found.row.tolist(), found.tokens.to_pylist()))
    assert Counter(listed) == expected
    sums = Counter()
    for key, weight in zip(listed, found.lines_left.tolist()):
        sums[key] += weight
    assert sums == weighted

    single = [re.sub(r"[\r\n]", "", t or "") for t in texts]
    found = text_tokens(pa.array(single, pa.string()), as_lines=True)
    assert Counter(zip(found.row.tolist(), found.tokens.to_pylist())) == Counter((i, t) for i, line in enumerate(single) for t in tokens_of(line))


def test_a_part_of_an_array():
    whole = pa.array(["skip this", None, "a b\n\nc", "", " x", "and that"], pa.string())
    found = text_tokens(whole.slice(1, 4))
    assert sorted(zip(found.row.tolist(), found.tokens.to_pylist())) == [(1, ""), (1, "a"), (1, "b"), (1, "c"), (3, ""), (3, "x")]


def test_same_counts_as_in_the_jvm(spark, docs):
    texts = [t for seed in range(60) for t in drawn(seed, 40) if t] + ["x" * 100_000, "\n" * 5_000, "K İ ß"]
    corpus = words.normalise(docs(*texts))
    in_pass = words.counted_words(corpus)
    in_jvm = words.word_counts(words.token_documents(corpus))
    assert in_pass.exceptAll(in_jvm).count() == in_jvm.exceptAll(in_pass).count() == 0


def test_regular_expressions_in_lists_of_any_length(docs):
    from wordloom.functions import stop_patterns

    corpus = docs("The cat\r\nsat on12 the mat", "aaa\n\nb.b")
    few = ["a+", "th", "[0-9]", "e", r"\.", "x"]
    many = [p for i in range(40) for p in (f"q{{{i + 2}}}", f"z{i}")] + few
    assert sum(not stop_patterns.is_literal(p) for p in few) <= stop_patterns.NESTED
    assert len(many) > stop_patterns.NESTED
    texts = lambda patterns: [r["text"] for r in words.normalise(corpus, stop_patterns=patterns).orderBy("doc_id").collect()]
    assert texts(few) == ["  ct\nst on   mt\n".replace("  ct", " ct").replace("on  ", "on "), "\n\nbb\n"]
    nested = stop_patterns.NESTED
    stop_patterns.NESTED = 2
    try:
        assert texts(few) == texts(many[-len(few):])
    finally:
        stop_patterns.NESTED = nested
    assert texts(many) == texts(few)
    lines = corpus.select("doc_id", F.explode(F.split("text", r"\r?\n")).alias("line"))
    strip = lambda patterns: sorted(r["line"] for r in words.normalise_lines(lines, stop_patterns=patterns).collect())
    assert strip(few) == strip(many)


class Passed:
    """Stands for rows: takes the function of an Arrow pass, so that it runs here."""

    def __init__(self, column):
        self.columns, self.sparkSession = ["doc_id", column], None
        self.schema = {"doc_id": StructField("doc_id", LongType())}

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


class Sent:
    value = ["common", "w7"]


PASSES = {
    "partial_counts": lambda rows: in_row.partial_counts(rows),
    "ranked_parts": lambda rows: in_row.ranked_parts(rows),
    "ranked_parts by document": lambda rows: in_row.ranked_parts(rows, by_document=True, stem=True),
    "partial_frequencies": lambda rows: in_row.partial_frequencies(rows, stem=True),
    "partial_frequencies of lines": lambda rows: in_row.partial_frequencies(rows, by_row=False),
    "partial_pairs": lambda rows: in_row.partial_pairs(rows, Sent, 4, False),
}


def batch_of(column, copies):
    texts = [" ".join(f"w{(i * 31 + j) % 997} common" for j in range(100)) for i in range(100)] * copies
    values = pa.array([t.split() for t in texts]) if column == "tokens" else pa.array(texts)
    ids = pa.array(np.arange(len(texts)))
    return pa.RecordBatch.from_arrays([ids, pa.array(np.ones(len(texts), bool)), values], ["doc_id", "whole", column])


@pytest.mark.parametrize("column", ["text", "line", "tokens"])
@pytest.mark.parametrize("name", PASSES)
def test_memory_of_a_pass_does_not_grow_with_its_batch(name, column):
    run, peaks = PASSES[name](Passed(column)), []
    for copies in (40, 160):  # from 4 to 16 MB of text
        batch = batch_of(column, copies)
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0] + 2_000_000


@pytest.mark.parametrize("limit", [1, 7, 40, 10**6])
@pytest.mark.parametrize("rows", [["ab", None, "", "c" * 30, "ä" * 3, "x"], [["ab", "c"], None, [], ["d" * 30], ["x"]], [], [None]])
def test_slices_hold_all_rows_in_order(rows, limit):
    kind = pa.list_(pa.string()) if rows and any(isinstance(r, list) for r in rows) else pa.string()
    whole = pa.array([["cut off"] if pa.types.is_list(kind) else "cut off", *rows], kind).slice(1)
    batch = pa.RecordBatch.from_arrays([whole], ["c"])
    found = list(sliced(iter([batch]), "c"))
    assert [r for b in found for r in b.column(0).to_pylist()] == rows
    assert all(b.num_rows for b in found)
    bounds = list(slice_bounds(whole, limit))
    assert [i for at, n in bounds for i in range(at, at + n)] == list(range(len(rows)))
    if limit == 1:
        assert all(sum(len(r or "") > 0 for r in rows[at : at + n]) <= 1 for at, n in bounds)
