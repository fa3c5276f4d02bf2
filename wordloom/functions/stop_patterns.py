"""Ordered deletion of stop patterns from running text.

Every pattern is deleted wherever it occurs, also inside words, and each deletion sees
the result of the ones before it. So the order matters and the list cannot be
folded into one alternation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def application_order(patterns: Iterable[str]) -> list[str]:
    """Distinct patterns in the order of a hash set of strings on the JVM.

    The set has the smallest power of two of buckets that keeps it at most 3/4 full
    (16 at least). The empty pattern takes a place in it but deletes nothing.
    """
    distinct = list(dict.fromkeys(patterns))
    buckets = 16
    while len(distinct) > buckets * 3 // 4:
        buckets *= 2

    def bucket(pattern: str) -> int:
        units = pattern.encode("utf-16-be")
        code = 0
        for high, low in zip(units[::2], units[1::2]):
            code = (31 * code + (high << 8 | low)) & 0xFFFFFFFF
        return (code ^ code >> 16) % buckets

    return [p for p in sorted(distinct, key=bucket) if p]


def is_literal(pattern: str) -> bool:
    return not set(pattern) & set(r"\^$.|?*+()[]{}")


def effective(patterns: Sequence[str]) -> list[str]:
    """Literal patterns without those that can no longer occur when their turn comes.

    A pattern of one character takes that character out for good, and with it every
    later pattern that contains it.
    """
    kept: list[str] = []
    gone: set[str] = set()
    for pattern in patterns:
        if gone.isdisjoint(pattern):
            kept.append(pattern)
            gone.update(pattern if len(pattern) == 1 else "")
    return kept


def remove_patterns(text: Column, patterns: Sequence[str]) -> Column:
    """Delete `patterns` one after the other, in the order given."""
    if not patterns:
        return text
    if all(is_literal(p) for p in patterns):
        return _literal_remover(effective(patterns))(text)
    return fold_patterns(text, patterns)


# Up to so many regular expressions are nested calls, whose patterns are compiled once per task; more would
# make an expression too deep.
NESTED = 64


def fold_patterns(text: Column, patterns: Sequence[str]) -> Column:
    """The same inside the JVM: needed for regular expressions, slower for long lists of literals.

    Literals that follow each other are one fold over their list, each regular expression is a call with a fixed pattern. A list with
    more than `NESTED` of those is a single fold, which compiles them again for each text.
    """
    if sum(not is_literal(p) for p in patterns) > NESTED:
        return _fold(text, patterns, _delete_entry)
    for literal, group in groupby(patterns, is_literal):
        if literal:
            text = _fold(text, list(group), lambda acc, entry: F.replace(acc, F.substr(entry, F.lit(2)), F.lit("")))
        else:
            for pattern in group:
                text = F.regexp_replace(text, F.lit(pattern), F.lit(""))
    return text


def fold_patterns_of_lines(lines: Column, patterns: Sequence[str]) -> Column:
    """Array of lines -> the same lines stripped. A long list goes through all lines pattern by pattern, so each is compiled once per array."""
    if sum(not is_literal(p) for p in patterns) <= NESTED:
        return F.transform(lines, lambda line: fold_patterns(line, patterns))
    return _fold(lines, patterns, lambda acc, entry: F.transform(acc, lambda line: _delete_entry(line, entry)))


def _fold(start: Column, patterns: Sequence[str], step: Callable[[Column, Column], Column]) -> Column:
    """One expression, however long the list. The first character of an entry tells literals from regular expressions."""
    listed = F.array(*[F.lit(("=" if is_literal(p) else "~") + p) for p in patterns])
    return F.aggregate(listed, start, step)


def _delete_entry(text: Column, entry: Column) -> Column:
    pattern = F.substr(entry, F.lit(2))
    literal = F.replace(text, pattern, F.lit(""))
    return F.when(F.startswith(entry, F.lit("=")), literal).otherwise(F.regexp_replace(text, pattern, F.lit("")))


def delete_literals(texts: pa.Array, patterns: Sequence[str]) -> pa.Array:
    """One vectorised pass over the batch per pattern."""
    for pattern in patterns:
        texts = pc.replace_substring(texts, pattern, "")
    return texts


def _literal_remover(patterns: list[str]):
    @F.arrow_udf("string")
    def strip(text: pa.Array) -> pa.Array:
        return delete_literals(text, patterns)

    return strip
