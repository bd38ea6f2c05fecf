"""Feature and score drift between a reference table and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.functions.binning import with_right_closed_bin
from adtally.functions.expressions import population_stability, ratio
from adtally.operators.selection import quantile_edges
from adtally.sources.staging import stage


def _check(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> None:
    for name in columns:
        for frame, label in ((reference, "reference"), (current, "current")):
            if name not in frame.columns:
                raise ValueError(f"{label} data is missing drift column: {name}")


def _number(df: DataFrame, name: str) -> Column:
    """The column as a double; text that is no number becomes null, and so does NaN."""
    value = F.expr(f"try_cast(`{name}` AS double)") if isinstance(df.schema[name].dataType, T.StringType) else F.col(
        name
    ).cast("double")
    return F.when(~F.isnan(value), value)


def _numeric_stats(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    """(column, <side>_rows, <side>_missing_rate, <side>_mean, <side>_std, <side>_valid) from one aggregate."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        value = _number(df, name)
        aggregates += [F.count(value).alias(f"n{i}"), F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    pieces = []
    for i, name in enumerate(columns):
        pieces += [F.lit(name), F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"s{i}")]
    wide = df.agg(*aggregates)
    return wide.select(
        "rows", F.stack(F.lit(len(columns)), *pieces).alias("column", "valid", "mean", "std")
    ).select(
        "column",
        F.col("rows").alias(f"{side}_rows"),
        F.col("valid").alias(f"{side}_valid"),
        ratio(F.col("rows") - F.col("valid"), F.col("rows")).alias(f"{side}_missing_rate"),
        F.col("mean").alias(f"{side}_mean"),
        F.col("std").alias(f"{side}_std"),
    )


def _binned(df: DataFrame, columns: Sequence[str], edges: dict[str, list[float]], side: int) -> DataFrame:
    """(column, bin, side) per non-null value."""
    names = {name: f"bin_{i}" for i, name in enumerate(columns)}
    numbers = df.select(*[_number(df, name).alias(name) for name in columns])
    wide = with_right_closed_bin(numbers, {names[name]: (F.col(name), edges[name][1:-1]) for name in columns})
    pieces = [piece for name in columns for piece in (F.lit(name), F.col(names[name]))]
    long = wide.select(F.stack(F.lit(len(columns)), *pieces).alias("column", "bin"), F.lit(side).alias("side"))
    return long.filter(F.col("bin").isNotNull())


def numeric_drift(reference: DataFrame, current: DataFrame, *, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Per column: rows, missing rates, means, population deviations and the stability index.

    The index compares shares over bins whose edges are exact quantiles of the reference. Bins empty on both
    sides contribute nothing and need no row.
    """
    _check(reference, current, columns)
    edges = quantile_edges(reference, {name: _number(reference, name) for name in columns}, bins=bins)
    counts = (
        _binned(reference, columns, edges, 0)
        .unionByName(_binned(current, columns, edges, 1))
        .groupBy("column", "bin")
        .agg(F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))
    )
    per_column = Window.partitionBy("column")
    shares = counts.withColumns(
        {
            "r": ratio(F.col("r"), F.sum("r").over(per_column)),
            "c": ratio(F.col("c"), F.sum("c").over(per_column)),
        }
    )
    index = shares.groupBy("column").agg(F.sum(population_stability(F.col("r"), F.col("c"))).alias("psi"))
    stats = _numeric_stats(reference, columns, "reference").join(
        # One row per column on every side of these joins.
        F.broadcast(_numeric_stats(current, columns, "current")), "column"
    )
    usable = (F.col("reference_valid") > 0) & (F.col("current_valid") > 0)
    return stats.join(F.broadcast(index), "column", "left").select(
        "column",
        F.lit("numeric").alias("kind"),
        "reference_rows",
        "current_rows",
        "reference_missing_rate",
        "current_missing_rate",
        "reference_mean",
        "current_mean",
        (F.col("current_mean") - F.col("reference_mean")).alias("mean_delta"),
        "reference_std",
        "current_std",
        F.when(usable, F.col("psi")).alias("psi"),
    )


def _values(df: DataFrame, columns: Sequence[str], side: int) -> DataFrame:
    pieces = [item for name in columns for item in (F.lit(name), F.col(name).cast("string"))]
    return df.select(F.stack(F.lit(len(columns)), *pieces).alias("column", "value"), F.lit(side).alias("side"))


def categorical_drift(
    reference: DataFrame, current: DataFrame, *, columns: Sequence[str], top_n: int = 20
) -> DataFrame:
    """Per column: missing rates, distinct values, top values, share of new values and the stability index.

    One grouped count per (column, value) holds both sides. The index covers the union of the top values of
    each side, null counted as a value. Equal counts are ordered by value, numbers before text.
    """
    _check(reference, current, columns)
    counts = (
        _values(reference, columns, 0)
        .unionByName(_values(current, columns, 1))
        .groupBy("column", "value")
        .agg(F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))
    )
    # Every figure below is read from these counts; the two tables are scanned once.
    counts = stage(counts, "value-counts")
    known = F.col("value").isNotNull()
    # Count first, then the smaller value: the order in which `max_by` and the top lists prefer values.
    number = F.expr("try_cast(value AS double)")
    totals = counts.groupBy("column").agg(
        F.sum("r").alias("reference_rows"),
        F.sum("c").alias("current_rows"),
        ratio(F.sum(F.when(~known, F.col("r"))), F.sum("r")).alias("reference_missing_rate"),
        ratio(F.sum(F.when(~known, F.col("c"))), F.sum("c")).alias("current_missing_rate"),
        F.count_if(known & (F.col("r") > 0)).alias("reference_unique"),
        F.count_if(known & (F.col("c") > 0)).alias("current_unique"),
        ratio(F.sum(F.when(known & (F.col("r") == 0), F.col("c")).otherwise(0)), F.sum("c")).alias(
            "new_category_share"
        ),
    )

    def top(count: str) -> DataFrame:
        # A row_number limit is applied within each task before the shuffle, so a column with very many
        # values sends only its leaders.
        best = Window.partitionBy("column").orderBy(
            F.desc(count), F.asc_nulls_last("number"), F.asc_nulls_last("value")
        )
        return (
            counts.filter(F.col(count) > 0)
            .withColumn("number", number)
            .withColumn("place", F.row_number().over(best))
            .filter(F.col("place") <= top_n)
            .select("column", "value", "r", "c", "place")
        )

    top_reference, top_current = top("r"), top("c")
    # At most columns x 2 x top_n rows from here on.
    leaders = top_reference.select("column", "value", "r", "c").union(
        top_current.select("column", "value", "r", "c")
    ).distinct()
    sizes = totals.select("column", "reference_rows", "current_rows")
    index = (
        leaders.join(F.broadcast(sizes), "column")
        .groupBy("column")
        .agg(
            F.sum(
                population_stability(
                    F.coalesce(ratio(F.col("r"), F.col("reference_rows")), F.lit(0.0)),
                    F.coalesce(ratio(F.col("c"), F.col("current_rows")), F.lit(0.0)),
                )
            ).alias("psi")
        )
    )
    first = lambda df, alias: df.filter(F.col("place") == 1).select(
        "column", F.col("value").alias(alias)
    )
    return (
        totals.join(F.broadcast(index), "column", "left")
        .join(F.broadcast(first(top_reference, "top_reference_category")), "column", "left")
        .join(F.broadcast(first(top_current, "top_current_category")), "column", "left")
        .select(
            "column",
            F.lit("categorical").alias("kind"),
            "reference_rows",
            "current_rows",
            F.coalesce("reference_missing_rate", F.when(F.col("reference_rows") > 0, 0.0)).alias(
                "reference_missing_rate"
            ),
            F.coalesce("current_missing_rate", F.when(F.col("current_rows") > 0, 0.0)).alias("current_missing_rate"),
            "reference_unique",
            "current_unique",
            "new_category_share",
            "top_reference_category",
            "top_current_category",
            "psi",
        )
    )


def drift_summary(numeric: DataFrame, categorical: DataFrame | None, scores: DataFrame) -> DataFrame:
    """One row: table sizes, numbers of checked columns, and the largest index of features and of scores."""
    shared = ["column", "kind", "reference_rows", "current_rows", "psi"]
    rows = numeric.select(*shared, F.lit("feature").alias("role")).unionByName(
        scores.select(*shared, F.lit("score").alias("role"))
    )
    if categorical is not None:
        rows = rows.unionByName(categorical.select(*shared, F.lit("feature").alias("role")))
    is_feature = F.col("role") == "feature"
    return rows.agg(
        F.max("reference_rows").alias("reference_rows"),
        F.max("current_rows").alias("current_rows"),
        F.count_if(is_feature & (F.col("kind") == "numeric")).alias("numeric_feature_count"),
        F.count_if(is_feature & (F.col("kind") == "categorical")).alias("categorical_feature_count"),
        F.count_if(~is_feature).alias("score_count"),
        F.max(F.when(is_feature, F.col("psi"))).alias("max_feature_psi"),
        F.max(F.when(~is_feature, F.col("psi"))).alias("max_score_psi"),
    )
