"""Numbers by ranges against Python's sort."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from wordloom.operators.numbering import bounds, numbered, range_number
from wordloom.operators.vocabulary import lexicographic_index


def test_numbers_follow_the_order_with_nulls_first(spark):
    ids = [None, None, *range(-50, 900), 7, 7]
    random.Random(1).shuffle(ids)
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    found = numbered(rows, ["id"], ranges=13).collect()
    in_order = sorted(found, key=lambda r: r["place"])
    assert [r["place"] for r in in_order] == list(range(len(ids)))
    assert [r["id"] for r in in_order] == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert {r["n"] for r in found} == {len(ids)}


def test_groups_of_any_size_have_numbers_of_their_own(spark):
    pick = random.Random(2)
    rows = [(pick.choice("aaaaaab") if i % 50 else f"g{i}", f"w{pick.randrange(10**6):06d}", i) for i in range(2_000)]
    expected = defaultdict(list)
    for g, w, i in rows:
        expected[g].append((w, i))
    found = defaultdict(list)
    table = spark.createDataFrame(rows, "g string, w string, i long")
    for r in numbered(table, ["w", "i"], group=["g"], ranges=9).collect():
        found[r["g"]].append((r["place"], (r["w"], r["i"])))
        assert r["n"] == len(expected[r["g"]])
    assert {g: [key for _, key in sorted(v)] for g, v in found.items()} == {g: sorted(v) for g, v in expected.items()}
    assert all([p for p, _ in sorted(v)] == list(range(len(v))) for v in found.values())


def test_words_with_one_common_prefix_spread_over_the_ranges(spark):
    words = spark.range(20_000).select(F.format_string("%s%08d", F.lit("z" * 40), F.col("id")).alias("word"))
    cuts = bounds(words, ["word"], 16)
    sizes = words.groupBy(range_number(words, ["word"], cuts).alias("r")).count().collect()
    assert len(sizes) == 16
    assert max(r["count"] for r in sizes) < 2.5 * 20_000 / 16
    index = lexicographic_index(words)
    assert dict(index.dtypes) == {"word": "string", "idx": "bigint"}
    assert index.where(F.col("idx") != F.substring("word", 41, 8).cast("long")).count() == 0


def test_index_of_repeated_words_and_of_none(spark):
    words = spark.createDataFrame([("b",), ("a",), ("b",), ("",), ("B",), ("ba",)], "word string")
    for small in (True, False):
        assert sorted(map(tuple, lexicographic_index(words, small).collect())) == [("", 0), ("B", 1), ("a", 2), ("b", 3), ("ba", 4)]
        assert lexicographic_index(words.where("false"), small).collect() == []


def test_nothing_to_number(spark):
    rows = spark.createDataFrame([], "id long")
    assert numbered(rows, ["id"]).collect() == []
