"""Every named query against its SQL equivalent, and invariants across queries."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from wordloom.plans import catalogue, sql_equivalents

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    return connection


def test_every_query_has_an_equivalent():
    assert set(catalogue.all_queries()) == set(sql_equivalents.all_sql())
    assert set(catalogue.all_queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalogue.all_queries()))
def test_query_equals_sql(spark, database, name):
    found = catalogue.all_queries()[name](spark, SF_DIR).toPandas()
    expected = database.execute(sql_equivalents.all_sql()[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    found, expected = (
        df[columns].sort_values(columns).reset_index(drop=True) for df in (found, expected)
    )
    pd.testing.assert_frame_equal(found, expected)


def test_entry(spark):
    assert contract.entry(spark).columns == ["word", "n"]
    assert contract.entry(spark).count() == 50
