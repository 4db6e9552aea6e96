"""Every registered query against its SQL, on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def _plain(value):
    return value.isoformat()[:19] if hasattr(value, "isoformat") else value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    """Same rows, and a plan without nested loops or forced broadcasts."""
    df = contract.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ResolvedHint", "hint=("))
    columns = sorted(df.columns)
    result = con.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    expected = _sorted(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    assert _sorted(tuple(_plain(row[c]) for c in columns) for row in df.collect()) == expected
