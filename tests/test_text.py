"""Line and token rules, case folding and stop patterns on small tables."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import stop_patterns as stops
from wordloom.operators import words
from wordloom.plans.catalogue import stop_patterns

LINES = {
    "x\r\ny\rz\n\nw\n": ["x", "y", "z", "", "w"],
    "": [],
    "\n": [""],
    "a": ["a"],
    "a\n\n": ["a", ""],
    "\r\n\r\n": ["", ""],
}
TOKENS = {
    "": [""],
    "...": [],
    "...a": ["", "a"],
    "a..": ["a"],
    "a b's": ["a", "b's"],
    "café x": ["caf", "x"],
    "é": [],
    "_a1-B": ["_a1", "B"],
}


def model_lines(text):
    parts = re.split(r"\r\n?|\n", text)
    return parts[:-1] if parts[-1] == "" else parts


def model_tokens(line):
    if line == "":
        return [""]
    parts = re.split(r"[^a-zA-Z0-9_']+", line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_line_table(docs):
    texts = list(LINES)
    rows = words.line_records(docs(*texts)).orderBy("doc_id", "line_no").collect()
    for i, text in enumerate(texts):
        assert [r["line"] for r in rows if r["doc_id"] == i] == LINES[text]
        assert [r["line_no"] for r in rows if r["doc_id"] == i] == list(range(len(LINES[text])))


def test_token_table(spark):
    lines = spark.createDataFrame([(t,) for t in TOKENS], "line string")
    found = words.token_lines(lines.withColumn("was", F.col("line"))).collect()
    assert {r["was"]: r["tokens"] for r in found} == TOKENS


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text("ab'.é \n\r", max_size=30), min_size=20, max_size=60))
def test_document_pass_equals_line_by_line(docs, texts):
    texts = [t for t in texts if t] or ["a"]
    corpus = words.normalise(docs(*texts))
    whole = {r["doc_id"]: r["tokens"] for r in words.token_documents(corpus).collect()}
    assert whole == {i: [t for line in model_lines(x) for t in model_tokens(line)] for i, x in enumerate(texts)}
    by_line = words.tokens(words.line_records(corpus)).orderBy("doc_id", "line_no", "pos").collect()
    for i in range(len(texts)):
        assert [r["token"] for r in by_line if r["doc_id"] == i] == whole[i]


def test_case(docs):
    rows = words.word_counts(words.token_documents(words.normalise(docs("The the THE")))).collect()
    assert [(r["word"], r["n"]) for r in rows] == [("the", 3)]
    kept = words.word_counts(words.token_documents(words.normalise(docs("The the THE"), case_sensitive=True)))
    assert kept.count() == 3


def test_application_order_of_the_stated_list():
    patterns = stop_patterns()
    assert len(patterns) == 354
    assert sorted(p for p in patterns if p.endswith(" ")) == ["al ", "de ", "el ", "er ", "es "]
    assert patterns[:4] == ["been", "mostly", "gotten", "don't"] and patterns[-2:] == ["until", "further"]
    assert stops.application_order(["b", "a", "a", ""]) == ["a", "b"]


@pytest.mark.parametrize("word, left", [("american", "eric"), ("have", "hve")])
def test_stripped_words_of_the_stated_list(docs, word, left):
    stripped = words.normalise(docs(word), stop_patterns=stop_patterns())
    assert words.token_documents(stripped).first()["tokens"] == [left]


@settings(max_examples=8, deadline=None)
@given(
    texts=st.lists(st.text("adehls \n\r.", min_size=1, max_size=40), min_size=20, max_size=40),
    literals=st.permutations(["a", "de ", "he", "es ", "hade", "l"]),
    regex=st.sampled_from([[], ["s."]]),
)
def test_patterns_go_one_after_the_other_on_each_line(docs, texts, literals, regex):
    patterns = literals[:3] + regex + literals[3:]

    def strip(line):
        for p in patterns:
            line = re.sub(p, "", line)
        return line

    rows = words.line_records(words.normalise(docs(*texts), stop_patterns=patterns)).orderBy("line_no").collect()
    for i, text in enumerate(texts):
        assert [r["line"] for r in rows if r["doc_id"] == i] == [strip(line) for line in model_lines(text)]


def test_arrow_and_fold_forms_agree(spark):
    lines = spark.createDataFrame([("several people were here, also american ones ",), (None,), ("",)], "line string")
    patterns = stop_patterns()
    both = lines.select(
        stops.remove_patterns(F.col("line"), patterns).alias("a"), stops.fold_patterns(F.col("line"), patterns).alias("b")
    ).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both]


def test_a_deletion_joins_no_line_ends(docs):
    for patterns in (["the"], ["th."]):
        corpus = words.normalise(docs("foo\rthe\nbar"), stop_patterns=patterns)
        assert [r["line"] for r in words.line_records(corpus).orderBy("line_no").collect()] == ["foo", "", "bar"]


def test_long_runs_of_separators(docs):
    texts = ["-\n" * 100_000 + "end", "\u4e2d\u6587\n" * 100_000, "a\r\n" + "\r\n" * 50_000 + "..\n" * 50_000 + "b"]
    corpus = words.normalise(docs(*texts))
    whole = {r["doc_id"]: r["tokens"] for r in words.token_documents(corpus).collect()}
    assert whole == {i: [t for line in model_lines(x) for t in model_tokens(line)] for i, x in enumerate(texts)}


def test_stop_lists_of_any_length(spark):
    patterns = [p for i in range(1000) for p in (f"w{i:04d}", f"v{i:04d}[a-c]?")]
    text = "w0001v0002aw0999 v0500xw0500v0999c end"
    expected = text
    for p in patterns:
        expected = re.sub(p, "", expected)
    line = spark.createDataFrame([(text,)], "line string")
    assert line.select(stops.remove_patterns(F.col("line"), patterns)).first()[0] == expected


def test_a_line_that_loses_everything_stays_a_line(docs):
    corpus = words.normalise(docs("xyz\nof", "of", "of\n"), stop_patterns=["of"])
    rows = words.token_documents(corpus).orderBy("doc_id").collect()
    assert [r["tokens"] for r in rows] == [["xyz", ""], [""], [""]]


def test_patterns_that_cannot_occur_any_more_are_skipped():
    assert stops.effective(["an", "a", "have", "he", "e", "the", "it"]) == ["an", "a", "he", "e", "it"]
    assert len(stops.effective(stop_patterns())) < 300
