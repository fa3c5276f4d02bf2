"""Secret scans: fixed patterns, and a battery of randomness tests for everything else that may be a key.

The patterns of `BASE` give spans of their own. Besides, every run of 20 or more characters of
`[A-Za-z0-9+/_-]` is a candidate; `=` ends a run, so in `NAME=value` both sides are runs and padding belongs to none.
Where base spans cover a part of a run, what is left on either side counts as runs of its own. The encoding of a candidate is inferred: the smallest alphabet of `ALPHABETS` that holds it.
Under the hypothesis that its characters are drawn evenly and independently from that alphabet three tests
apply: chi-squared against the even distribution (exact moments, as tokens are short against the
alphabet), the number of runs of characters of the same class (upper, lower, digit, other) and of the same half of
the alphabet, and the serial correlation of neighbours. Words and identifiers repeat letters, change their class rarely
and have related neighbours; each test is one-sided in that direction or two-sided for the correlation.
The p-values are combined by their harmonic mean, which holds for dependent tests too.

Which candidates are not random is decided by the Benjamini-Hochberg procedure over all candidates
of the corpus, in strata of encoding and length, so that the many short tokens, which tests can tell apart
least, do not set the threshold of the long ones. Those that stay unrejected are reported. Strata in which a
token could not be rejected whatever it is, because its alphabet has only one class of characters, ask for
twice the length. The procedure needs counts per stratum and bin of p only, whose number is bounded.

Null text is empty and has no spans. Rows are scanned one by one, whole; the ids need not differ.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.stored import kept_as_table

# The kinds in their order, with their patterns and the least length of what counts.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# These two match as far as their characters go, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = (("assign", re.compile(ASSIGN, re.I | re.A), 2, 6), ("access", re.compile(ACCESS), 0, 20), ("hex", re.compile(HEX), 0, 24))
KINDS = (*(kind for kind, *_ in BASE), "random")

SHORTEST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# (name, characters, least length); in rising size.
ALPHABETS = (
    ("decimal", _DIGITS, 1 << 30),  # numbers are not secrets
    ("hex", _DIGITS + "abcdef", 20),
    ("HEX", _DIGITS + "ABCDEF", 20),
    ("lower", _LOWER, 40),
    ("upper", _UPPER, 40),
    ("base32", _UPPER + "234567", 20),
    ("base36", _DIGITS + _LOWER, 20),
    ("BASE36", _DIGITS + _UPPER, 20),
    ("base62", _DIGITS + _LOWER + _UPPER, 20),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", 20),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", 20),
    ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_", 40),
)
RATE = 0.05
BINS = 64  # of -log10 p, a quarter each
LENGTH_BITS = 16

HITS = (
    "struct<base: array<struct<start: bigint, kind: int, stop: bigint>>,"
    " tested: array<struct<start: bigint, kind: int, stop: bigint, stratum: int, bin: int>>>"
)
_CLASS = {c: i for i, part in enumerate((_DIGITS, _LOWER, _UPPER)) for c in part}
_CODES = [({c: i for i, c in enumerate(chars)}, set(chars), len(chars), least) for _, chars, least in ALPHABETS]
_CLASS_SHARE = [
    [sum(_CLASS.get(c, 3) == k for c in chars) / len(chars) for k in range(4)] for _, chars, _ in ALPHABETS
]


def _tail(z: float) -> float:
    """Upper tail of the normal distribution."""
    from math import erfc, sqrt

    return max(0.5 * erfc(z / sqrt(2)), 1e-300)


def encoding(token: str) -> int:
    seen = set(token)
    return next((i for i, (_, chars, _, _) in enumerate(_CODES) if seen <= chars), -1)


def _run_p(same: float, expected: float, n: int) -> float:
    """`same` of n - 1 neighbours agree, each with the expected probability: is that too many?"""
    spread = ((n - 1) * expected * (1 - expected)) ** 0.5
    return _tail((same - 0.5 - (n - 1) * expected) / spread) if spread > 0 else 1.0


def randomness(token: str, kind: int) -> float:
    """Combined p-value of the battery: small means not random."""
    codes, _, size, _ = _CODES[kind]
    n = len(token)
    x = np.array([codes[c] for c in token])
    counts = np.bincount(x, minlength=size)
    chi = size / n * float((counts**2).sum()) - n
    p_even = _tail((chi - (size - 1)) / (2 * (size - 1) * (1 - 1 / n)) ** 0.5)
    classes = np.array([_CLASS.get(c, 3) for c in token])
    p_class = _run_p(float((classes[1:] == classes[:-1]).sum()), sum(s * s for s in _CLASS_SHARE[kind]), n)
    high = x * 2 >= size
    p_half = _run_p(float((high[1:] == high[:-1]).sum()), 0.5, n)
    centred = x - (size - 1) / 2
    variance = (size * size - 1) / 12
    z = float((centred[1:] * centred[:-1]).sum()) / (variance * (n - 1) ** 0.5)
    p_serial = min(1.0, 2 * _tail(abs(z)))
    ps = (p_even, p_class, p_half, p_serial)
    return min(1.0, len(ps) / sum(1 / p for p in ps))


def _outside(start: int, stop: int, covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of a run lies outside the covered spans, which are in order."""
    parts = []
    for a, b in covered:
        if a > start:
            parts.append((start, a))
        start = max(start, b)
    return [*parts, (start, stop)]


def _scanned(text: str) -> dict:
    base = []
    for kind, (_, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                base.append((m.start(), kind, m.end()))
    base.sort()
    # Base spans start in order, and few are open at a time: those that end before a run are left behind.
    tested, begun, open_ = [], 0, []
    for m in CANDIDATE.finditer(text):
        while begun < len(base) and base[begun][0] < m.end():
            open_.append((base[begun][0], base[begun][2]))
            begun += 1
        open_ = [x for x in open_ if x[1] > m.start()]
        for start, stop in _outside(m.start(), m.end(), open_):
            token = text[start:stop]
            if len(token) < SHORTEST or len(token) < ALPHABETS[kind := encoding(token)][2]:
                continue
            bin_ = min(BINS - 1, int(-4 * np.log10(randomness(token, kind))))
            length = min(LENGTH_BITS - 1, len(token).bit_length())
            tested.append((start, len(BASE), stop, kind * LENGTH_BITS + length, bin_))
    return {
        "base": [dict(zip(("start", "kind", "stop"), b)) for b in base],
        "tested": [dict(zip(("start", "kind", "stop", "stratum", "bin"), t)) for t in tested],
    }


def _hits(text: Column) -> Column:
    span = [("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]
    more = [("stratum", pa.int32()), ("bin", pa.int32())]
    kind = pa.struct([("base", pa.list_(pa.struct(span))), ("tested", pa.list_(pa.struct(span + more)))])

    @F.arrow_udf(HITS)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([_scanned(t.as_py() or "") for t in texts], kind)

    return scan.asNondeterministic()(text)


def scanned(rows: DataFrame, text: str = "text") -> DataFrame:
    """Rows -> (doc, hits), `doc` being the row without its text as a struct."""
    kept = [F.col(c) for c in rows.columns if c != text] or [F.lit(None).alias("nothing")]
    return rows.select(F.struct(*kept).alias("doc"), _hits(F.col(text)).alias("hits"))


def thresholds(hits: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Scanned rows -> {stratum: first bin that is rejected}, by Benjamini-Hochberg within each stratum.

    Only counts per stratum and bin come to the driver: at most as many as there are strata times bins.
    """
    tested = hits.select(F.explode("hits.tested").alias("t")).groupBy("t.stratum", "t.bin").agg(F.count("*").alias("n"))
    counts: dict[int, list[int]] = {}
    for stratum, bin_, n in tested.collect():
        counts.setdefault(stratum, [0] * BINS)[bin_] += n
    first = {}
    for stratum, own in counts.items():
        total, beyond = sum(own), 0
        first[stratum] = BINS
        for bin_ in range(BINS - 1, -1, -1):
            beyond += own[bin_]
            # All of this bin and beyond have p <= 10^(-bin / 4); the last such bin that holds is the threshold.
            if beyond and 10 ** (-bin_ / 4) <= rate * beyond / total:
                first[stratum] = bin_
    return first


def spans(hits: DataFrame, first: dict[int, int]) -> DataFrame:
    """Scanned rows -> (doc, base, found): base spans, and all spans, in order of start and kind."""
    if first:
        known = F.create_map(*[F.lit(x) for pair in sorted(first.items()) for x in pair])
        random = F.filter("hits.tested", lambda t: t["bin"] < F.element_at(known, t["stratum"]))
    else:
        random = F.slice("hits.tested", 1, 0)
    plain = F.transform(random, lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["stop"].alias("stop")))
    return hits.select("doc", F.col("hits.base").alias("base"), F.array_sort(F.concat("hits.base", plain)).alias("found"))


def written(found: Column) -> Column:
    """Spans as `kind:start:end`, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the secrets of every row of `documents`."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    hits = kept_as_table(scanned(documents))  # the texts are scanned once; what is kept are spans
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return spans(hits, thresholds(hits)).select(
        "doc.doc_id",
        *[n(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
