"""Join-heavy queries under the plan shape of a large cluster: no size-based
broadcast (only the explicit hints on bounded tables), so joins become
shuffled sort-merge joins. Results must still equal the SQL oracle."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
JOIN_HEAVY = ["bridge", "bridge_durable", "multi_version", "scd2_rename", "fact_disaster",
              "nearest_place", "code_lookup", "staging_antijoin", "keep_first", "fk_violations",
              "rebuild", "surrogate_keys", "quality_metrics"]


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", JOIN_HEAVY)
def test_sort_merge_plans_match_oracle(no_broadcast, name):
    con = duck(SF)
    msg, ok = compare(no_broadcast, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert ok, msg
