"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import TESTDATA, connect, differences

SF = f"{TESTDATA}/sf0.01"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Plan nodes that pair all rows or leave the JVM row by row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["horizon", "mse", "mae", "rmse", "mape", "rrse", "corr"]
    assert out.count() == 4


def test_bernoulli_sample_size(spark):
    n = QUERIES["bernoulli_sample"](spark, SF).count()
    assert 50 < n < 160  # 100 expected
