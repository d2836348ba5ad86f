"""Every query against its SQL, values, types and row counts."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences
from checks.registry import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert differences(df, con, sql) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_comparison_sees_differences(spark, con):
    df = queries()["product_profile"](spark, SF_DIR)
    sql = oracle_sql()["product_profile"]
    assert differences(df, con, sql) == []
    assert differences(df, con, f"SELECT is_active, unit, rows + 1 AS rows FROM ({sql})")
    assert differences(df, con, f"SELECT * FROM ({sql}) LIMIT 1")
    assert differences(df, con, f"SELECT is_active, unit, CAST(rows AS INTEGER) AS rows FROM ({sql})")
    assert differences(df, con, f"SELECT is_active AS active, unit, rows FROM ({sql})")


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries())
    assert set(SQL) <= set(oracle_sql())
