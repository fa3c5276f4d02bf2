"""Merkle manifest, exact dedup and hard negatives against models in plain Python, and their odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import decontamination, exact_dedup, hard_negatives, merkle

H = lambda text: hashlib.sha256(text.encode()).hexdigest()
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["a", "b", "batch", "copy", "times", "key", "id", "h", "place", "n", "window", "steps", "kept", "uid", "norm", "angles", "part", "block"]


def clashing(rows):
    return rows.withColumns({c: F.lit("x") for c in CLASH if c not in rows.columns})


# exact dedup


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected_classes(rows, stays=max):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[fold(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, seen = (stays(known) if known else None), False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not seen, H(text)))
            seen |= i == keep
    return sorted(out, key=repr)


TEXTS = [
    (1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (None, "same"), (2, "same"), (9, "same"), (9, "same"), (9, "SAME"), (None, "lone"), (None, "Lone"),
    (7, "Ärger"), (8, "ärger"), (11, "ÄRGER"), (12, "İ"), (13, "i̇"), (14, "x" * 300_000 + "Y"), (15, "x" * 300_000 + "y"), (-1, "\x00"), (-2, " "),
]


@pytest.mark.parametrize("keep, stays", [("largest", max), ("smallest", min)])
def test_classes_and_what_stays(spark, keep, stays, monkeypatch):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    for hot, unfolded in ((1_000, 4_096), (3, 2)):
        monkeypatch.setattr(exact_dedup, "HOT", hot)
        monkeypatch.setattr(exact_dedup, "UNFOLDED", unfolded)
        found = sorted(map(tuple, exact_dedup.deduplicated(clashing(rows), keep).collect()), key=repr)
        assert found == expected_classes(TEXTS, stays)


def test_colliding_hashes_are_told_apart_by_the_bytes(spark, monkeypatch):
    real = exact_dedup.hashed
    monkeypatch.setattr(exact_dedup, "hashed", lambda d: real(d).withColumns({"a": F.lit(1).cast("long"), "b": F.lit(2).cast("long")}))
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.deduplicated(rows, "largest").collect()), key=repr) == expected_classes(TEXTS)


def test_survivors_keep_their_columns(spark):
    rows = clashing(spark.createDataFrame([(1, "x"), (2, "X"), (3, "y")], "doc_id long, text string"))
    left = exact_dedup.survivors(rows, exact_dedup.deduplicated(rows))
    assert left.columns == rows.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3]


def test_a_hot_text_is_broadcast_not_shuffled(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3_000)]
    found = exact_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), "largest")
    assert {r["group_size"] for r in found.where("keep_id = 2997").collect()} == {1000}
    assert sorted(map(tuple, found.collect()), key=repr) == expected_classes(rows)
    assert "BroadcastHashJoin" in found._jdf.queryExecution().toString()


def test_no_documents(spark):
    rows = spark.createDataFrame([], DOCUMENT)
    assert exact_dedup.deduplicated(rows).collect() == []
    assert merkle.manifest(rows).collect() == []


# Merkle manifest


def expected_tree(leaves, arity):
    """-> the root and, for each leaf, its siblings from the bottom up as (left, right)."""
    level, paths, below = list(leaves), [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, above = [], []
        for at in range(0, len(level), arity):
            run = level[at : at + arity]
            for j in range(len(run)):
                for i in below[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(H("".join(run)))
            above.append([i for b in below[at : at + arity] for i in b])
        level, below = up, above
    return level[0], paths


def leaf_of(doc_id, text, lang, source, n_chars):
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return H("".join(parts))


def expected_manifest(rows, arity=2):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[2] is not None, (row[2] or "").encode())].append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    names = sorted(groups)
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = expected_tree([x[2] for x in groups[name]], arity)
    root, tops = expected_tree([trees[n][0] for n in names], arity)
    out = []
    for name, top in zip(names, tops):
        subroot, paths = trees[name]
        for (_, _, leaf, row), path in zip(groups[name], paths):
            doc_id, text, lang, source, n_chars = row
            hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            h = leaf_of(doc_id, text, lang, source, n_chars + 1) if hit else leaf
            for left, right in path + top:
                h = H(left + h + right)
            out.append((doc_id, leaf, subroot, root, H("".join(a + b for a, b in path + top)), h, h == root))
    return sorted(out, key=repr)


def manifest_rows(spark, rows, **how):
    found = merkle.manifest(clashing(spark.createDataFrame(rows, DOCUMENT)), **how)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    proof = F.sha2(merkle.proof_text(F.col("steps")), 256)
    return sorted(map(tuple, found.select("doc_id", "leaf", "subroot", "root", proof, folded, folded == F.col("root")).collect()), key=repr)


ODD_DOCUMENTS = [
    (1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", 1), (None, None, None, None, None), (None, "x" * 200_000, "en", None, 2**63 - 1),
    (5, "ä€😀", "äö", "s", None), (6, "", "", "", 0), (7, "q", "Z", "s", -3), (34, "big", "z", "s", 2**63 - 1),
]


@pytest.mark.parametrize("arity, levels", [(2, 10), (2, 2), (3, 2), (5, 1)])
def test_manifest_of_many_and_odd_documents(spark, arity, levels):
    pick = random.Random(4)
    rows = ODD_DOCUMENTS + [(i, f"t{i}", pick.choice(["en", "en", "en", "de", None]), "s", i) for i in range(10, 170)]
    pick.shuffle(rows)
    expected = expected_manifest(rows, arity)
    assert manifest_rows(spark, rows, arity=arity, levels=levels) == expected
    assert {v for *_, v in expected} == {True, False}


@pytest.mark.parametrize("rows", [[(3, "a", "en", "s", 1)], [(3, "a", "en", "s", 1), (4, "b", "de", "s", 1), (5, "b", None, "s", 1)], [(i, "", "en", "", 0) for i in range(4)]])
def test_manifest_of_few_documents(spark, rows):
    assert manifest_rows(spark, rows) == expected_manifest(rows)


def test_a_window_holds_so_many_leaves_whatever_the_partition(spark):
    rows = spark.range(500).select(F.lit("=en").alias("key"), "id", F.col("id").cast("string").alias("h"), F.col("id").alias("place"), F.lit(500).alias("n"))
    tiers, _ = merkle.in_tiers(rows, 2, 3)
    assert [t.groupBy("window").count().agg(F.max("count")).first()[0] for t in tiers] == [8, 8, 8]


# hard negatives


def expected_negatives(rows, positives=5, negatives=10):
    usable = [
        (i, v, [int(np.floor(256 * float(x))) for x in e], label)
        for i, (v, e, label) in enumerate(rows)
        if None not in (v, e, label) and all(x is not None and np.isfinite(x) for x in e)
    ]
    limit = 2**63
    score = lambda p, q: max(-limit, min(limit - 1, sum(x * y for x, y in zip(p, q))))
    out = []
    for i, v, q, label in usable:
        if v % 100:
            continue
        ranked = sorted((-score(q, r), w, j, other) for j, w, r, other in usable if j != i)
        for ps, p, *_ in [x for x in ranked if x[3] == label][:positives]:
            found = [(w, -s) for s, w, _, other in ranked if other != label and 30 * -ps <= 100 * -s <= 90 * -ps]
            out += [(v, p, k + 1, w, -ps, s) for k, (w, s) in enumerate(found[:negatives])]
    return sorted(out)


def vectors(n, seed, dims=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, dims))
    return [(i, [float(np.float32(x)) for x in centres[i % 4] + draw.normal(size=dims) * (0.3 if i % 2 else 1.5)], int(draw.integers(4))) for i in range(n)]


ODD_VECTORS = [
    (None, [1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("inf")], 1), (4, [float("nan")], 1), (100, [1.0, 2.0], None), (200, [], 1), (300, [0.0] * 6, 2),
    (400, [2.0], 0), (400, [2.0], 0), (400, [2.0, 1.0], 0), (-100, [-1.0, -1.0, 0.5], 3), (500, [0.25] * 9, 1), (600, [3.0, 1.0], 77), (600, [3.0, 1.0], 77), (5, [3.0, 1.0], 0), (6, [3.0, 1.0], 0),
]


@pytest.mark.parametrize("block_rows, block_anchors", [(4_096, 1_024), (40, 3)])
def test_hard_negatives_of_odd_vectors(spark, block_rows, block_anchors):
    rows = vectors(320, 1) + ODD_VECTORS
    table = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    found = hard_negatives.mined(table, block_rows=block_rows, block_anchors=block_anchors)
    assert sorted(map(tuple, found.collect())) == expected_negatives(rows)


def test_scores_beyond_doubles_and_beyond_64_bits(spark):
    rows = [(100, [2.0**40, 3.0, 1.0], 1), (1, [2.0**38, 5.0, 1.0], 1), (2, [2.0**30, 7.0, 3.0], 2), (3, [2.0**37, 1.0, 9.0], 2), (4, [2.0**37, 1.0, 9.5], 3), (200, [1e38, 1.0], 1), (5, [-1e38], 1)]
    found = hard_negatives.mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(map(tuple, found.collect())) == expected_negatives(rows)


def test_no_vectors(spark):
    rows = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mined(rows).collect() == []


def test_bounds_hold_and_leave_rows_out():
    draw = np.random.default_rng(3)
    pa = hard_negatives.pa
    centres = draw.normal(size=(5, 12))
    made = np.concatenate([c + draw.normal(size=(40, 12)) * 0.1 for c in centres])
    quantised = hard_negatives._quantised(made)
    norms = np.linalg.norm(quantised, axis=1)
    references = centres / np.linalg.norm(centres, axis=1)[:, None]
    angles = hard_negatives._angles(quantised, norms, references)
    lists = lambda m: pa.array([list(r) for r in m])
    n = len(made)
    struct = pa.StructArray.from_arrays(
        [pa.array(range(n)), pa.array(range(n)), pa.array([i // 40 for i in range(n)]), pa.array(norms), lists(angles), lists(made)],
        ["uid", "vec_id", "label", "norm", "angles", "embedding"],
    )
    block = hard_negatives._Block(struct)
    lower, upper = hard_negatives._bounds(block, slice(0, n), block)
    scores = quantised @ quantised.T
    assert (lower <= scores).all() and (scores <= upper).all()
    # The upper bounds of most pairs of different clusters are below the scores inside a cluster.
    inside = np.diag(scores) * 0.9
    assert (upper < inside[:, None]).mean() > 0.5


# benchmark decontamination by blocks


def test_blocks_of_a_benchmark_find_what_one_block_finds(spark, monkeypatch):
    pick = random.Random(6)
    word = lambda: f"w{pick.randrange(400)}"
    texts = [" ".join(word() for _ in range(pick.choice((1, 3, 12, 40)))) for _ in range(30)]
    items = [(i, texts[i % 30]) for i in range(45)] + [(7, texts[7]), (None, texts[3]), (90, None), (91, ""), (92, "!!")]
    rows = [(i, " ".join([*(word() for _ in range(20)), pick.choice(texts), *(word() for _ in range(20))])) for i in range(60)] + [(60, None), (None, texts[5]), (3, texts[5])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).withColumns({c: F.lit("x") for c in ("found", "doc", "text_id", "item_id")})
    one = sorted(map(tuple, decontamination.found_items(docs, benchmark).collect()), key=repr)
    clean = sorted(map(tuple, decontamination.without_items(docs, benchmark).collect()), key=repr)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    blocks = list(decontamination.text_blocks(decontamination.distinct_texts(benchmark)))
    assert len(blocks) > 3 and sum(map(len, blocks)) == 33
    assert sorted(map(tuple, decontamination.found_items(docs, benchmark).collect()), key=repr) == one
    assert sorted(map(tuple, decontamination.without_items(docs, benchmark).collect()), key=repr) == clean
    assert decontamination.without_items(docs, benchmark).columns == docs.columns
    words_of = lambda text: (text or "").split()

    def shingles(words, n):
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    expected = []
    for doc_id, text in rows:
        for item_id, item in items:
            own = [w for w in words_of(item) if w != "!!"]
            n = min(5, len(own))
            if own:
                wanted = shingles(own, n)
                shared = len(wanted & shingles(words_of(text), n))
                if 100 * shared >= 80 * len(wanted):
                    expected.append((doc_id, item_id, shared, len(wanted)))
    assert one == sorted(expected, key=repr)
    assert len(clean) < len(rows) and len(clean) == len([r for r in rows if not any(e[0] == r[0] for e in expected)])
