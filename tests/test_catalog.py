"""The registered queries against their SQL, and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows_of
from tests.conftest import SMALL

# The slow ones are covered by tests of their own operators.
SLOW = {"st2_hourly_stream", "r04_pq_train", "m19_learn_vectors"}
NAMES = sorted(set(contract.queries()) - SLOW)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(cols, cur.fetchall())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["p11_prepare", "r01_exact_search_blocks", "st4_backfill", "m08_pool_by_spec"])
def test_no_cross_join_in_the_plan(spark, name):
    plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = contract.queries()["o02_top_k"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_filters_reach_the_scan(spark):
    df = contract.queries()["f11_profile_attributes"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey" in plan and "c_name" not in plan
