"""Table profile: null rates, means, distinct counts and a numeric description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.operators.selection import quantiles, without_nan


def table_profile(
    df: DataFrame, *, mean_columns: Sequence[str] = (), distinct_columns: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """(measure, column, value): row and column counts, null rate per column, means, distinct non-null values.

    Exact distinct counts group (column, value) pairs, which collapse before the shuffle. `approximate` takes
    them from a sketch in the main pass instead.
    """
    names = df.columns
    aggregates = [F.count(F.lit(1)).cast("double").alias("rows")]
    aggregates += [F.avg(F.col(name).isNull().cast("double")).alias(f"null|{name}") for name in names]
    aggregates += [F.avg(name).alias(f"mean|{name}") for name in mean_columns]
    if approximate:
        aggregates += [
            F.approx_count_distinct(name).cast("double").alias(f"distinct|{name}") for name in distinct_columns
        ]
    pieces: list[Column] = [F.lit("rows"), F.lit("*"), F.col("rows")]
    pieces += [F.lit("columns"), F.lit("*"), F.lit(float(len(names)))]
    measured = [("null_rate", "null", name) for name in names] + [("mean", "mean", name) for name in mean_columns]
    if approximate:
        measured += [("distinct", "distinct", name) for name in distinct_columns]
    for measure, prefix, name in measured:
        pieces += [F.lit(measure), F.lit(name), F.col(f"`{prefix}|{name}`")]
    profile = df.agg(*aggregates).select(
        F.stack(F.lit(2 + len(measured)), *pieces).alias("measure", "column", "value")
    )
    if approximate or not distinct_columns:
        return profile
    pairs = [item for name in distinct_columns for item in (F.lit(name), F.col(name).cast("string"))]
    distinct = (
        df.select(F.stack(F.lit(len(distinct_columns)), *pairs).alias("column", "text"))
        .filter(F.col("text").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(F.lit("distinct").alias("measure"), "column", "value")
    )
    return profile.unionByName(distinct)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column, one row each; NaN counts as null."""
    numbers = {name: without_nan(F.col(name).cast("double")) for name in columns}
    aggregates = []
    for i, name in enumerate(columns):
        value = numbers[name]
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"m{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
            F.min(value).alias(f"a{i}"),
            F.max(value).alias(f"z{i}"),
        ]
    row = df.agg(*aggregates).first()
    quartiles = quantiles(df, numbers, bins=4)
    out = [
        (name, *(row[f"{part}{i}"] for part in "nmsa"), *(quartiles[name][1:4] or [None] * 3), row[f"z{i}"])
        for i, name in enumerate(columns)
    ]
    measures = ("mean", "std", "min", "p25", "p50", "p75", "max")
    schema = "column string, count long, " + ", ".join(f"{measure} double" for measure in measures)
    return df.sparkSession.createDataFrame(out, schema)
