import pytest

from __spark_entry__ import entry, oracle_sql, queries
from adtally.plans.catalog import named_queries
from check_oracles import compare, connect
from oracles import oracle_queries

QUERIES = named_queries()
ORACLES = oracle_queries()
FITTED = {name for name in QUERIES if name not in ORACLES}


def test_every_oracle_has_a_query_and_only_fits_lack_one():
    assert set(ORACLES) <= set(QUERIES)
    assert all("model" in name for name in FITTED)


def test_entry_points_hold_every_query():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    assert compare(spark, duck, folder, name, QUERIES[name], ORACLES[name]).startswith("ok")


# Reports over bounded rows may use one partition; these return a row per log row and must not.
ROW_LEVEL = ["ad_log", "rank_features", "lineitem_rank", "time_split", "time_slices", "known_effect_columns"]


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_row_level_queries_never_meet_in_one_partition(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
