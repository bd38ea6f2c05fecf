import pytest
from pyspark.sql import functions as F

from adtally.operators.features import add_recency_transforms, apply_feature_set, expected_value_top


def inputs(spark):
    return spark.createDataFrame(
        [(1, 0.0, 5.0, -1), (2, 3.0, 1.0, 0), (3, 1.0, 3.0, 3600)],
        "id int, cost double, cpo double, time_since_last_click long",
    )


def test_rank_feature_set(spark):
    rows = apply_feature_set(inputs(spark), "semisynthetic_rank_v1").orderBy("id").collect()
    assert [r.has_prev_click for r in rows] == [0, 1, 1]
    assert [r.time_since_last_click for r in rows] == [None, 0.0, 3600.0]
    assert [r.recency_bucket for r in rows] == [0, 0, 1]
    assert [round(r.cost_rank, 6) for r in rows] == [round(1 / 3, 6), 1.0, round(2 / 3, 6)]
    assert [round(r.recency_rank, 6) for r in rows] == [0.5, 0.5, 1.0]
    assert all(0 <= r.cpo_rank <= 1 for r in rows)


def test_unknown_and_empty_set(spark):
    with pytest.raises(ValueError, match="Unsupported feature_builder: nope"):
        apply_feature_set(inputs(spark), "nope")
    for name in (None, "none"):
        assert apply_feature_set(inputs(spark), name).columns == inputs(spark).columns


def test_recency_buckets_are_right_closed(spark):
    values = [-1.0, 0.0, 0.5, 0.6, 3600.0, 3601.0, 86400.0, 86401.0, 604800.0, 604801.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, time_since_last_click double")
    got = [r.recency_bucket for r in add_recency_transforms(df).orderBy("id").collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4]


def test_expected_value_top(spark):
    df = inputs(spark).withColumns({"p": F.lit(0.5), "timestamp": F.col("id"), "uid": F.col("id"), "campaign": F.lit(1)})
    assert [r.id for r in expected_value_top(df, score_col="p", n=2).collect()] == [1, 3]
