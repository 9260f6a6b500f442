"""Every named query against the same result written in SQL and run by another engine."""

import duckdb
import pytest

import __spark_entry__ as contract
from orderlake.plans import oracle
from orderlake.plans.queries import registered

TABLES = ("lineitem", "orders", "customer", "part")
QUERIES = {name: build for name, build in contract.queries().items() if name in registered()}
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(small_data):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_data}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, small_data, name):
    ours = QUERIES[name](spark, small_data)
    theirs = duck.execute(ORACLE[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = sorted(repr(row) for row in theirs.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in ours.collect()) == expected


def test_flagship(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["ORDER_DATE", "TOTAL_REVENUE", "NUM_ORDERS", "NUM_LINE_ITEMS", "AOV"]
    assert not frame.isEmpty()
