"""Every registered relational query against its DuckDB twin."""

import duckdb
import pytest

from tarnwheel.plans import catalog
from tarnwheel.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(r[k] for k in order) for r in found), key=repr)


@pytest.mark.parametrize("name", catalog.ORACLE)
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_plans_push_down_and_prune(spark):
    plan = catalog.QUERIES["q_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_discount:double,l_shipdate" in plan
    plan = catalog.QUERIES["q_top_per_group"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    plan = catalog.QUERIES["q_range_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
