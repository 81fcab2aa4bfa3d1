"""Every registered plan on the small tables; those with SQL must agree with DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from bramble.plans.registry import PLANS, TABLES
from check import table

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{ROOT}/{t}.parquet'")
    return con


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns and df.limit(1).count() == 1


@pytest.mark.parametrize("name", list(PLANS))
def test_plan(spark, duck, name):
    df = contract.queries()[name](spark, ROOT)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns and got[1]
        assert len(set(got[0])) == len(got[0])
        return
    want = duck.sql(sql)
    assert got == table(want.columns, want.fetchall())
