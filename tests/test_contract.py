"""Every registered query against its SQL on the smallest data, when the data is there."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
import check

DATA = "/root/testdata/sf0.001"
OWN = sorted(set(contract.queries()) - set(contract.EXTRA_QUERIES))
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data folder")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DATA}/{name}.parquet')")
    return con


def test_sql_is_given_for_registered_queries_only():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(OWN) - set(contract.oracle_sql()) == {"search_vector_approx"}


@pytest.mark.parametrize("name", OWN)
def test_query(spark, db, name):
    df = contract.queries()[name](spark, DATA)
    got = check.rows([tuple(r) for r in df.collect()], df.columns)
    if name not in contract.oracle_sql():
        assert got
        return
    result = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.types_differ(df, result.description) == {}
    assert got == check.rows(result.fetchall(), columns)
