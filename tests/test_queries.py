"""Every registered query against its SQL in DuckDB, over the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    path = f"{SF_DIR}/orders.parquet"
    connection.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{path}')")
    return connection


OWN = sorted(query.__name__ for query in registry._QUERIES)


def test_every_query_has_its_sql():
    assert set(OWN) <= set(registry.queries())
    assert set(OWN) <= set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    flagship = registry.entry(spark)
    assert flagship.count() == 1650
    assert flagship.schema["eff_to_dt"].dataType.simpleString() == "date"


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    result = registry.queries()[name](spark, SF_DIR)
    oracle = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in oracle.description]
    assert sorted(columns) == sorted(result.columns)
    have = sorted(map(tuple, result.select(*columns).collect()), key=str)
    want = sorted(oracle.fetchall(), key=str)
    assert len(want) > 0
    assert have == want
