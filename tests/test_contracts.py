import pytest
from pyspark.sql import functions as F

from adtally.operators import contracts as C


def source(spark, rows=2):
    values = [
        {
            "timestamp": 1 + i, "uid": 10 + i, "campaign": 100 + i, "click": i % 2, "cost": 0.5 + i, "cpo": 2.0 + i,
            "time_since_last_click": -1 if i == 0 else 3600, **{f"cat{c}": 1 + i for c in range(1, 10)},
        }
        for i in range(rows)
    ]
    types = ", ".join(f"{name} {'double' if kind == 'numeric' else 'long'}" for name, kind in C.SOURCE_CONTRACT.items())
    return spark.createDataFrame([tuple(v[n] for n in C.SOURCE_CONTRACT) for v in values], types)


def test_valid_source_passes(spark):
    C.check_source(source(spark))


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match=r"baseline source is missing required columns: \['campaign'\]"):
        C.check_source_schema(source(spark).drop("campaign"))


def test_wrong_type_is_named(spark):
    df = source(spark).withColumn("uid", F.col("uid").cast("double"))
    with pytest.raises(ValueError, match="uid expected integer, found double"):
        C.check_source_schema(df)


def test_label_must_be_binary(spark):
    with pytest.raises(ValueError, match="click must be binary .*found 1 other rows from 2 to 2"):
        C.check_source_schema(source(spark).withColumn("click", F.col("click") * 2))


def test_duplicate_key(spark):
    df = source(spark).withColumns({"uid": F.lit(10), "timestamp": F.lit(1), "campaign": F.lit(100)})
    with pytest.raises(ValueError, match="duplicate uid/timestamp/campaign keys: 1"):
        C.check_source(df)


def test_full_duplicates_come_before_keys(spark):
    df = source(spark)
    with pytest.raises(ValueError, match="contains 2 fully duplicated rows"):
        C.check_source(df.unionByName(df))


def test_nulls_and_minimums(spark):
    df = source(spark)
    with pytest.raises(ValueError, match=r"nulls in required columns: \['cpo', 'cat3'\]"):
        C.require(
            C.quality_violations(
                df.withColumn("cpo", F.when(F.col("uid") > 10, F.col("cpo"))).withColumn("cat3", F.lit(None).cast("long"))
            )
        )
    with pytest.raises(ValueError, match="cost must be >= 0; found minimum -0.5"):
        C.require(C.quality_violations(df.withColumn("cost", F.col("cost") - 1.0)))
    C.require(C.quality_violations(df.withColumn("time_since_last_click", F.lit(-1))))


def test_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a long, b long")
    assert C.duplicate_count(df, ["a", "b"]).first()[0] == 1


def test_training_contract_keeps_first_kind():
    found = C.training_contract(
        label_col="click", timestamp_col="timestamp", numeric_features=["x", "click"], categorical_features=["x", "c"]
    )
    assert found == {"timestamp": "integer", "click": "integer", "x": "numeric", "c": "integer"}


def test_fractions():
    C.check_fraction(1.0, name="f")
    for bad in (0.0, 1.1, -0.1):
        with pytest.raises(ValueError, match="f must be between 0 and 1"):
            C.check_fraction(bad, name="f")
    with pytest.raises(ValueError, match="between 0 and 0.5"):
        C.check_fraction(0.5, name="f", below=0.5)


def test_overlap(spark):
    df = spark.createDataFrame([(1,), (1,)], "t int")
    with pytest.raises(ValueError, match="both treated and control"):
        C.check_overlap(df, "t")
