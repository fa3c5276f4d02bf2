"""Porter's suffix stripper as rule tables, and the Arrow UDF that applies it.

The rules are those of M. F. Porter, "An algorithm for suffix stripping", Program 14
(1980), with the two amendments of his own later distribution (`bli` for `abli`, and
`logi`). Words of one or two letters stay as they are.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

MEMO_ENTRIES = 500_000

# Suffix -> replacement where the part before the suffix has measure > 0.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# Suffixes deleted where the part before has measure > 1.
STEP_4 = {
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
}


def _by_length(suffixes) -> tuple[str, ...]:
    return tuple(sorted(suffixes, key=len, reverse=True))


_SUFFIXES_2, _SUFFIXES_3, _SUFFIXES_4 = map(_by_length, (STEP_2, STEP_3, STEP_4))


def _longest_suffix(word: str, suffixes: tuple[str, ...]) -> str | None:
    if not word.endswith(suffixes):
        return None
    return next(s for s in suffixes if word.endswith(s))


_SHAPES = str.maketrans({chr(c): "v" if chr(c) in "aeiou" else "c" for c in range(128)})


def _shape(word: str) -> str:
    """One letter per (ASCII) character: v for a vowel, c otherwise; y is v after a c."""
    if "y" not in word:
        return word.translate(_SHAPES)
    shape = ""
    for char in word:
        vowel = char in "aeiou" or (char == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_syllable(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _plural(word: str) -> str:
    if word.endswith(("sses", "ies")):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_or_gerund(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return _repair(stem) if "v" in _shape(stem) else word
    return word


def _repair(stem: str) -> str:
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_syllable(stem) else stem


def _final_y(word: str) -> str:
    return word[:-1] + "i" if word.endswith("y") and "v" in _shape(word[:-1]) else word


def _replace(word: str, suffixes: tuple[str, ...], replacement: dict[str, str]) -> str:
    suffix = _longest_suffix(word, suffixes)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    return stem + replacement[suffix] if _measure(stem) > 0 else word


def _delete(word: str) -> str:
    suffix = _longest_suffix(word, _SUFFIXES_4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if suffix == "ion" and stem[-1:] not in ("s", "t"):
        return word
    return stem if _measure(stem) > 1 else word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        measure = _measure(word[:-1])
        if measure > 1 or (measure == 1 and not _short_syllable(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def porter_stem(word: str) -> str:
    if len(word) < 3:
        return word
    word = _final_y(_past_or_gerund(_plural(word)))
    word = _replace(word, _SUFFIXES_2, STEP_2)
    word = _replace(word, _SUFFIXES_3, STEP_3)
    return _final_e(_delete(word))


class Stemmer:
    """Stems of lists of words; each distinct word is stemmed once while it is remembered."""

    def __init__(self):
        self.memo: dict[str, str] = {}

    def __call__(self, words: list[str]) -> list[str]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        for word in words:
            if word not in self.memo:
                self.memo[word] = porter_stem(word)
        return [self.memo[w] for w in words]


def stems_udf():
    """Arrow UDF: array of tokens -> array of their stems.

    Each distinct token of a batch is stemmed once; the arrays are rebuilt from
    dictionary codes without a Python loop over tokens.
    """
    stemmer = Stemmer()

    @F.arrow_udf("array<string>")
    def stems(tokens: pa.Array) -> pa.Array:
        coded = tokens.flatten().dictionary_encode()
        stemmed = pa.array(stemmer(coded.dictionary.to_pylist()), pa.string()).take(coded.indices)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0)
        ends = pc.cumulative_sum(sizes.cast(pa.int32()))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(offsets, stemmed, mask=tokens.is_null())

    return stems
