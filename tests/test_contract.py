"""Driver contract: entry() runs, every query has a callable, and every oracle
statement matches its Spark query on the smallest test tables."""

import pytest

import __spark_entry__ as E
from quakehouse.plans.registry import QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["DisasterKey", "SeismicKey", "DistanceKM", "TimeLagDays"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


FORBIDDEN = ["CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
             "MapInPandas"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cartesian_or_python(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    msg, ok = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert ok, msg
