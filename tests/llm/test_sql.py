"""Queries against their SQL, on the smallest tables and on a fixture of odd rows."""

import random

import duckdb
import pandas as pd
import pytest

from wordloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None,
    "",
    " \t\n ",
    "one",
    "a b c a b c a b c",
    "x y\nx y\n\nx y\nx y",
    "line one\nline two\nline three\nend",
    "other\nline one\nline two\nmore\nline two\nline three",
    "line one\nline two\nline three\nend",
    "A B C! a,b;c  Ä ß é\u00a0z \x85 k",
    "wörd " * 60 + "# # $ %",
    "LOUD WORDS EVERYWHERE " * 30,
    "the quick brown fox jumps over the lazy dog again and again",
    "x " * 20000 + "the quick brown fox jumps over the lazy dog again and again",
]
ITEMS = [(1, "The quick, brown fox jumps over the lazy dog"), (2, "fox jumps"), (3, None), (4, "!!"), (4, "quick brown fox"), (None, "one")]
URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.COM", "http://com/", "http://example.com/en/x?y#z", "https://www.Example.com/en/",
    "x://a.net/es/1", "x://net/es", "x://n.net/fr/", "a://b://c.com/", "http://badexample.com/en/", "http://spam-farm.example.org/a", "http://q.org/adserver/1",
    "http://user@h.com:80/p", "http://e.com?x://net/es/", "http://example.com/en/x?y#z", "http://xcom/", "x://example.com/EN/",
]


def compare(spark, folder, name, file="{}.parquet"):
    found = queries.QUERIES[name](spark, folder).toPandas()
    database = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{file.format(table)}'")
    expected = database.execute(queries.SQL[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    found, expected = (df[columns].astype(object).where(df[columns].notna(), None) for df in (found, expected))
    as_rows = lambda df: sorted(map(tuple, df.itertuples(index=False)), key=repr)
    assert as_rows(found) == as_rows(expected)
    return found


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_smallest_tables(spark, name):
    assert len(compare(spark, SF_DIR, name)) > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_odd_rows(spark, tables, name):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(None, "line one\nline two", None, None, None)]
    vectors = [(i, [0.1 * (i % 7), -0.02 * i, 1.0][: 3 - i % 5 % 3], i % 3) for i in range(40)] + [(100, None, 1), (200, [None], 1), (300, [float("nan")], 1)]
    vectors += [(100, [0.3, 0.1, 0.9], 1), (100, [0.3, 0.1, 0.9], 1), (None, [1.0], 1), (4, [1.0], None), (700, [], 9), (-100, [0.2, 0.2, -1.0], -5)]
    folder = tables(documents=rows, embeddings=vectors, benchmark=ITEMS, pages=[(i, u, "") for i, u in enumerate(URLS)] + [(None, URLS[6], None), (3, URLS[6], "")])
    found = compare(spark, folder, name, "{}.parquet/*.parquet")
    assert isinstance(found, pd.DataFrame)


def test_runs_of_lines_by_their_words(spark, documents):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    pool = ["", "", " ", "a b", "c d e", "f g h i", "k l m n o p", "one two three four five six seven eight nine ten eleven"]
    texts = [f"x\n{passage}\ny", f"z\n{passage}\nw", passage, "q\n\n\nr", "s\n\n\nt"]
    texts += ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(80)]
    found = compare(spark, documents(*texts), "op3_line_dedup", "{}.parquet/*.parquet").set_index("doc_id").sort_index()
    assert found["n_removed"][:5].tolist() == [0, 1, 1, 0, 0] and found["longest_removed"].max() > 1


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tables, name):
    found = queries.QUERIES[name](spark, tables()).collect()
    assert len(found) == (1 if name.startswith("op1_") else 0)


def test_a_query_for_every_operator():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
