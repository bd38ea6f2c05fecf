"""Contract checks as tables of verdicts: what would be refused, where and why, without raising.

Each function gives one row per thing checked. Column verdicts read the schema only, value verdicts are one
aggregate over the table. `refuse` raises on the first verdict that is not `ok`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.operators.contracts import SOURCE_CONTRACT

OK = "ok"
_KINDS = {"integer": T.IntegralType, "numeric": T.NumericType, "any": T.DataType}


def column_verdicts(df: DataFrame, contract: Mapping[str, str] = SOURCE_CONTRACT) -> DataFrame:
    """(column, expected, verdict): `ok`, `missing` or `wrong type`, per column of the contract."""

    def verdict(name: str, kind: str) -> str:
        if name not in df.columns:
            return "missing"
        return OK if isinstance(df.schema[name].dataType, _KINDS[kind]) else "wrong type"

    rows = [(name, kind, verdict(name, kind)) for name, kind in contract.items()]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, verdict string")


def _counted(found: DataFrame, keys: Sequence[str], checks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per key and check (name -> (count column, verdict if it is not zero)) of a table of counts."""
    listed = [
        F.struct(
            F.lit(name).alias("check"), F.col(count).alias("violations"), F.when(F.col(count) == 0, OK).otherwise(F.lit(refusal)).alias("verdict")
        )
        for name, (count, refusal) in checks.items()
    ]
    return found.select(*keys, F.inline(F.array(*listed)))


def _not_binary(value: Column) -> Column:
    return F.count_if(value.isNotNull() & ~value.isin(0, 1))


def label_verdicts(df: DataFrame, *, label_col: str, split_col: str) -> DataFrame:
    """(split, check, violations, verdict): labels other than 0 and 1, and missing ones, per split of a training table."""
    found = df.groupBy(F.col(split_col).alias("split")).agg(
        _not_binary(F.col(label_col)).alias("other"), F.count_if(F.col(label_col).isNull()).alias("nulls")
    )
    return _counted(found, ["split"], {"binary": ("other", "not binary"), "null": ("nulls", "missing")})


def calibration_verdicts(df: DataFrame, *, label_col: str, score_col: str) -> DataFrame:
    """(check, violations, verdict) of a calibration input: rows, nulls, labels and scores."""
    label, score = F.col(label_col).cast("double"), F.col(score_col).cast("double")
    found = df.agg(
        (F.count(F.lit(1)) == 0).cast("long").alias("empty"),
        F.count_if(label.isNull() | score.isNull()).alias("nulls"),
        F.count_if(~label.isin(0.0, 1.0)).alias("labels"),
        F.count_if((score < 0.0) | (score > 1.0) | F.isnan(score)).alias("scores"),
    )
    return _counted(
        found, [],
        {"rows": ("empty", "empty"), "nulls": ("nulls", "missing values"), "labels": ("labels", "not binary"), "scores": ("scores", "no probability")},
    )


def overlap_verdicts(df: DataFrame, *, treatment_col: str, split_col: str) -> DataFrame:
    """(split, treated, control, verdict): a split without both arms cannot train uplift models."""
    value = F.col(treatment_col)
    found = df.groupBy(F.col(split_col).alias("split")).agg(F.count_if(value == 1).alias("treated"), F.count_if(value == 0).alias("control"))
    verdict = F.when(F.col("treated") == 0, "no treated rows").when(F.col("control") == 0, "no control rows").otherwise(OK)
    return found.withColumn("verdict", verdict)


def split_verdicts(df: DataFrame, fractions: Sequence[tuple[float, float]]) -> DataFrame:
    """(train_fraction, validation_fraction, verdict, train_rows, validation_rows, test_rows) of split arguments on a table.

    Fractions must be positive and leave rows for the test; rows of refused ones are null.
    """
    asked = df.sparkSession.createDataFrame([(float(a), float(b)) for a, b in fractions], "train_fraction double, validation_fraction double")
    a, b, n = F.col("train_fraction"), F.col("validation_fraction"), F.lit(df.count())
    verdict = (
        F.when((a <= 0.0) | (a >= 1.0), "train fraction out of range")
        .when(b < 0.0, "validation fraction out of range")
        .when(a + b >= 1.0, "no test rows left")
        .otherwise(OK)
    )
    counted = asked.withColumn("verdict", verdict)
    train = F.floor(n * a)
    rows = {"train_rows": train, "validation_rows": F.floor(n * (a + b)) - train, "test_rows": n - F.floor(n * (a + b))}
    kept = {name: F.when(F.col("verdict") == OK, value) for name, value in rows.items()}
    return counted.select("train_fraction", "validation_fraction", "verdict", *[value.alias(name) for name, value in kept.items()])


def refuse(verdicts: DataFrame, what: str) -> None:
    """Raise with the first verdict that is not `ok`."""
    bad = verdicts.filter(F.col("verdict") != OK)
    row = bad.orderBy(*bad.columns).first()
    if row is not None:
        raise ValueError(f"{what} refused: {row.asDict()}")
