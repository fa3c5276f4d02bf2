"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule in an integer, so that policies, which are sets of rules with a
version, are applied afterwards by `failures & policy`, and the effect of leaving a rule
out of a policy is an aggregation over the distinct bit patterns.

Measured on words `[^\\x20\\x09-\\x0D]+` of the whole text. Null and empty texts have no
words and fail `few_words`; all their measurements are 0. Rows are judged one by one:
repeated rows, ties and null ids change nothing. The ledger is a struct column beside the
rows, so columns of any name may come with them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.wordspans import U64, mixed, shingle_hashes, shingle_starts, slices

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_shouted",
)

# The rules by bit. A rule fails a row where its condition holds.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_shouted > 30 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

# Policies by version: the rules that reject. Later versions never change earlier ones.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": tuple(name for name, _ in RULES),
}
CURRENT = "v2"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True


def _repeat_words(words: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Words within runs of three words that the same text has twice or more."""
    text = np.repeat(np.arange(len(n_words)), n_words)
    fits = shingle_starts(n_words, 3)
    key = shingle_hashes(words, 3) ^ mixed(text[: len(fits)].astype(U64) + U64(1))
    at = np.flatnonzero(fits)
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(words), bool)
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    for j in range(3):
        repeated[order[twice] + j] = True
    return np.bincount(text[repeated], minlength=len(n_words))


def _duplicate_lines(s) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them equal to an earlier line."""
    breaks = np.flatnonzero(s.data == 10)
    starts = np.unique(np.concatenate([s.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(s.data)]
    next_break = np.append(breaks, len(s.data))[np.searchsorted(breaks, starts)]
    ends = np.minimum(next_break, s.bounds[np.searchsorted(s.bounds, starts, "right")])
    worded = np.searchsorted(s.starts, ends) > np.searchsorted(s.starts, starts)
    starts, ends = starts[worded], ends[worded]
    text = np.searchsorted(s.bounds, starts, "right") - 1
    key = s.hashes(starts, ends) ^ mixed(text.astype(U64) + U64(1))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(text, minlength=s.n), np.bincount(text[again], minlength=s.n)


def _measured(texts: pa.Array) -> pa.StructArray:
    columns = {name: np.zeros(len(texts), np.int64) for name in MEASURES}
    for s in slices(texts):
        here = slice(s.first, s.first + s.n)
        columns["n_words"][here] = s.n_words
        columns["word_chars"][here] = s.per_text(s.solid & ((s.data & 0xC0) != 0x80))
        columns["n_symbols"][here] = s.per_text(_SYMBOL[s.data])
        columns["n_lines"][here], columns["n_dup_lines"][here] = _duplicate_lines(s)
        columns["n_repeat_words"][here] = _repeat_words(s.word_hashes(), s.n_words)
        upper, lower = np.zeros((2, len(s.data) + 1), np.int64)
        np.cumsum(_UPPER[s.data], out=upper[1:])
        np.cumsum(_LOWER[s.data], out=lower[1:])
        shouted = (upper[s.ends] - upper[s.starts] >= 2) & (lower[s.ends] == lower[s.starts])
        columns["n_shouted"][here] = np.bincount(s.text_of_word[shouted], minlength=s.n)
    return pa.StructArray.from_arrays([pa.array(columns[m]) for m in MEASURES], list(MEASURES))


def measures(text: Column) -> Column:
    """Struct of all measurements; marked non-deterministic so that it is worked out once."""
    schema = "struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">"

    @F.arrow_udf(schema)
    def measure(texts: pa.Array) -> pa.Array:
        return _measured(texts)

    return measure.asNondeterministic()(text)


def with_ledger(rows: DataFrame, text: str = "text", name: str = "ledger") -> DataFrame:
    """Rows -> the same rows and a struct `ledger` of the measurements and `failures`."""
    held = rows.withColumn(name, measures(F.col(text)))
    failed = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(RULES):
        words = condition.split()
        held_in = " ".join(f"{name}.{w}" if w in MEASURES else w for w in words)
        failed = failed.bitwiseOR(F.when(F.expr(held_in), F.lit(1 << i)).otherwise(0).cast("long"))
    return held.withColumn(name, F.struct(*[F.col(f"{name}.{m}").alias(m) for m in MEASURES], failed.alias("failures")))


def mask(rules: Sequence[str]) -> int:
    return sum(BIT[r] for r in set(rules))


def passes(failures: Column, rules: Sequence[str]) -> Column:
    """Does a policy keep the row?"""
    return failures.bitwiseAND(F.lit(mask(rules)).cast("long")) == 0


def ablation(failures: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """(failures) -> (policy, rule, rejected, by_rule, only_rule).

    Of the rows that a policy rejects: how many fail this rule, and how many would be kept
    without it. One aggregation to at most 2^rules bit patterns; the rest works on those.
    """
    patterns = failures.groupBy("failures").agg(F.count("*").alias("n"))
    wanted = F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(mask(rules)).alias("mask"), F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit"))
        for p, rules in policies.items()
        for r in rules
    ])
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    n = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return patterns.select("failures", "n", F.inline(wanted)).groupBy("policy", "rule").agg(
        n(hit != 0).alias("rejected"),
        n(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("by_rule"),
        n(hit == F.col("bit")).alias("only_rule"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the ledger of `documents` under the base rules and the current policy."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = with_ledger(documents)
    failures = F.col("ledger.failures")
    return ledger.select(
        "doc_id",
        *[F.col(f"ledger.{m}").alias(m) for m in MEASURES[:5]],
        (~passes(failures, POLICIES["base"])).alias("base_failed"),
        passes(failures, POLICIES[CURRENT]).alias("kept"),
        failures.alias("failures"),
        *[F.col(f"ledger.{m}").alias(m) for m in MEASURES[5:]],
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps, with their own columns."""
    held = with_ledger(docs.select(F.struct("*").alias("doc"), F.col("text").alias("text")))
    return held.where(passes(F.col("ledger.failures"), POLICIES[CURRENT])).select("doc.*")


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), tokens AS (
    SELECT row_no, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), windows AS (
    SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS run
    FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM tokens)
), repeated AS (
    SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, run) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT row_no, count(DISTINCT i + j) AS n_repeat_words
    FROM repeated CROSS JOIN (SELECT unnest(range(0, 3)) AS j) GROUP BY row_no
), lines AS (
    SELECT row_no, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_no
), measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0)::BIGINT AS n_lines,
        len(list_filter(words, lambda w: regexp_matches(w, '[A-Z].*[A-Z]') AND NOT regexp_matches(w, '[a-z]')))::BIGINT AS n_shouted
    FROM tokens LEFT JOIN lines USING (row_no) LEFT JOIN covered USING (row_no)
), judged AS (
    SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
        + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
        + 16 * (100 * n_shouted > 30 * n_words)::BIGINT + 32 * (word_chars < 2 * n_words)::BIGINT
        + 64 * (word_chars > 15 * n_words)::BIGINT)::BIGINT AS failures
    FROM measured
)
SELECT *, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept FROM judged
"""
