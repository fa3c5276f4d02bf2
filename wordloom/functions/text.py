"""Case folding and tokenising as built-in column expressions.

Splitting leaves parts that are no lines or tokens at the ends of its array. They are
cut off by a function that names the array once (`bound`), so that the split stays a single
expression wherever plans merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates two tokens, and what ends a line. \w is ASCII, so an
# accented letter separates; the apostrophe belongs to the word.
SEPARATOR = r"[^\w']+"
LINE_END = r"\r\n?|\n"

# A separator within a line, or a line end with the separators before it and the lines
# of nothing but separators after it. The lookahead lets word characters fail at once, and all
# repeats are possessive: none of them can give back anything that would match, and without
# that each line of separators would take a frame of the stack.
_GAP = r"[^\w'\r\n]"
LINE_OR_TOKEN_END = rf"(?=[^\w'])(?:{_GAP}*+(?:{LINE_END})(?:{_GAP}++(?:{LINE_END}))*+|{_GAP}++)"


def bound(value: Column, result: Callable[[Column], Column]) -> Column:
    """`result` of a value that is computed once, however often `result` uses it."""
    return F.transform(F.array(value), result)[0]


def fold_case(text: Column, case_sensitive: bool = False) -> Column:
    return text if case_sensitive else F.lower(text)


def with_plain_ends(text: Column) -> Column:
    """All line ends written as one character."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def split_lines(text: Column) -> Column:
    return F.split(text, LINE_END, -1)


def whole_lines(parts: Column) -> Column:
    """Lines: empty ones count, but nothing follows a final line end."""
    return bound(parts, lambda p: F.slice(p, F.lit(1), F.size(p) - (F.element_at(p, -1) == "").cast("int")))


def split_tokens(line: Column) -> Column:
    return F.split(line, SEPARATOR, -1)


def whole_tokens(parts: Column) -> Column:
    """Tokens of one line.

    A line that starts with a separator has an empty first token, an empty line has
    just that token, and a line of separators alone has none. Separators are maximal
    runs, so only the first and the last part can be empty.
    """

    def cut(p: Column) -> Column:
        n = F.size(p)
        last_is_empty = F.element_at(p, -1) == ""
        only_separators = (n == 2) & last_is_empty & (F.element_at(p, 1) == "")
        drop = F.when(only_separators, 2).when(last_is_empty & (n > 1), 1).otherwise(0)
        return F.slice(p, F.lit(1), n - drop)

    return bound(parts, cut)


def split_document(text: Column) -> Column:
    return F.split(F.concat(F.lit("\n"), ended(text)), LINE_OR_TOKEN_END, -1)


def whole_document(parts: Column) -> Column:
    """Tokens of all lines of a text, as line by line, but in one pass.

    Between two line ends there is an empty part exactly where a line by itself has an
    empty token. The parts outside the first and the last line end are no tokens.
    """
    return bound(parts, lambda p: F.slice(p, F.lit(2), F.size(p) - 2))


def ended(text: Column) -> Column:
    """Text whose last line has a line end too."""
    return bound(text, lambda t: F.when(F.right(t, F.lit(1)).isin("\r", "\n"), t).otherwise(F.concat(t, F.lit("\n"))))
