import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adtally.operators import ranking
from adtally.operators.ranking import value_buckets, with_average_ranks, with_bucket, with_row_number


def frame(spark, rows=4000):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(
        {
            "id": np.arange(rows),
            "hot": np.where(rng.random(rows) < 0.4, 1.5, rng.normal(size=rows)),
            "holes": np.where(rng.random(rows) < 0.35, np.nan, rng.integers(0, 50, rows)),
        }
    )
    df = spark.createDataFrame(pdf).withColumn("holes", F.when(~F.isnan("holes"), F.col("holes")))
    return pdf, df.repartition(6)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_average_ranks_match_pandas_with_hot_values_and_nulls(spark, partitions):
    pdf, df = frame(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        columns = {"a": F.col("hot"), "b": F.col("holes")}
        got = with_average_ranks(df, columns, rows_per_bucket=100).toPandas().sort_values("id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    np.testing.assert_allclose(got.a, pdf.hot.rank(pct=True))
    np.testing.assert_allclose(got.b.to_numpy(float), pdf.holes.rank(pct=True).to_numpy())


def test_hot_value_is_in_no_window(spark):
    """The rows sharing one value do not meet in one window group, and windows hold row numbers and values only."""
    _, df = frame(spark)
    columns = {"a": F.col("hot")}
    plan = with_average_ranks(df, columns, rows_per_bucket=100)._jdf.queryExecution().toString()
    assert "Exchange SinglePartition" not in plan
    windows = [line for line in plan.split("== Physical Plan ==")[0].splitlines() if "Window [" in line]
    assert windows and not any("holes" in line or "id#" in line for line in windows)
    buckets = value_buckets(df, columns, rows_per_bucket=100)
    totals = ranking._bucket_totals(df, columns, buckets)
    counted = with_bucket(df.filter("hot is not null"), F.col("hot"), buckets["a"], "__bucket").groupBy("__bucket").count()
    both = counted.join(totals, "__bucket")
    assert both.filter("not __one_value").agg(F.max("count")).first()[0] < 400
    assert both.filter("__one_value").agg(F.max("count")).first()[0] > 1000


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_number_and_running_sum(spark, partitions):
    pdf, df = frame(spark)
    order = [F.desc_nulls_last("holes"), F.asc("id")]
    got = with_row_number(df, order, "rn", running={"gain": F.col("id")}, partitions=partitions).toPandas()
    want = pdf.sort_values(["holes", "id"], ascending=[False, True], na_position="last")
    got = got.sort_values("rn")
    assert got.rn.tolist() == list(range(1, len(pdf) + 1))
    assert got.id.tolist() == want.id.tolist()
    assert got.gain.tolist() == want.id.cumsum().tolist()


def test_user_columns_keep_their_names(spark):
    df = spark.createDataFrame([(3, 1, 9, 2.0), (4, 2, 8, 1.0)], "bucket int, part int, slot int, value double")
    ranked = with_average_ranks(df, {"r": F.col("value")})
    numbered = with_row_number(ranked, [F.asc("value")], "n", running={"total": F.col("slot")})
    rows = sorted(tuple(row) for row in numbered.collect())
    assert numbered.columns == ["bucket", "part", "slot", "value", "r", "n", "total"]
    assert rows == [(3, 1, 9, 2.0, 1.0, 2, 17), (4, 2, 8, 1.0, 0.5, 1, 8)]
