"""Calibration drift: predicted against actual rates in the reference's score bins, for two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.binning import with_right_closed_bin
from adtally.functions.expressions import clipped_probability
from adtally.operators.contracts import check_calibration_input
from adtally.operators.selection import quantile_edges


def _labelled(df: DataFrame, label_col: str, score_col: str, side: str) -> DataFrame:
    return df.select(
        F.lit(side).alias("side"),
        F.col(label_col).cast("double").alias("y"),
        F.col(score_col).cast("double").alias("s"),
    )


def calibration_totals(
    reference: DataFrame, current: DataFrame, *, label_col: str, score_col: str, bins: int = 10
) -> DataFrame:
    """Sums per side and score bin, from one pass over both tables: at most two rows per bin."""
    if bins < 2:
        raise ValueError("bins must be at least 2")
    check_calibration_input(reference, label_col, score_col, frame_name="reference")
    check_calibration_input(current, label_col, score_col, frame_name="current")
    both = _labelled(reference, label_col, score_col, "reference").unionByName(
        _labelled(current, label_col, score_col, "current")
    )
    scores = {"s": F.col(score_col).cast("double")}
    edges = quantile_edges(reference, scores, bins=bins)["s"]
    p = clipped_probability(F.col("s"))
    return with_right_closed_bin(both, {"bin": (F.col("s"), edges[1:-1])}).groupBy("side", "bin").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("y").alias("positives"),
        F.sum("s").alias("score_sum"),
        F.sum(-(F.col("y") * F.ln(p) + (1.0 - F.col("y")) * F.ln(1.0 - p))).alias("loss"),
        F.sum(F.pow(F.col("s") - F.col("y"), F.lit(2))).alias("squares"),
    )


def calibration_drift_bins(totals: DataFrame) -> DataFrame:
    """One row per bin that either side uses, a missing side counted as zero, numbered from 1."""
    def of(side: str, name: str):
        return F.sum(F.when(F.col("side") == side, F.col(name)))

    aggregates = []
    for side in ("reference", "current"):
        rows = of(side, "rows")
        aggregates += [
            F.coalesce(rows, F.lit(0)).alias(f"{side}_rows"),
            F.coalesce(of(side, "positives"), F.lit(0.0)).alias(f"{side}_positives"),
            F.coalesce(F.try_divide(of(side, "score_sum"), rows), F.lit(0.0)).alias(f"{side}_avg_score"),
            F.coalesce(F.try_divide(of(side, "positives"), rows), F.lit(0.0)).alias(f"{side}_actual_rate"),
        ]
    in_order = Window.partitionBy(F.lit(0)).orderBy("bin")
    return (
        totals.groupBy("bin")
        .agg(*aggregates)
        .select(
            F.row_number().over(in_order).alias("bin"),
            "reference_rows",
            "current_rows",
            "reference_positives",
            "current_positives",
            "reference_avg_score",
            "current_avg_score",
            (F.col("current_avg_score") - F.col("reference_avg_score")).alias("avg_score_delta"),
            "reference_actual_rate",
            "current_actual_rate",
            (F.col("current_actual_rate") - F.col("reference_actual_rate")).alias("actual_rate_delta"),
        )
        .orderBy("bin")
    )


# Measures reported for both sides and as a difference.
_MEASURES = ("positive_rate", "avg_score", "log_loss", "brier_score", "calibration_mae")


def calibration_drift_summary(totals: DataFrame) -> DataFrame:
    """One row: both sides' rates, losses and row-weighted calibration error, their differences, the worst bins."""
    error = F.abs(F.col("score_sum") / F.col("rows") - F.col("positives") / F.col("rows")) * F.col("rows")
    aggregates = []
    for side in ("reference", "current"):
        here = F.col("side") == side
        total = lambda column: F.sum(F.when(here, column))  # noqa: B023, E731
        rows = total(F.col("rows"))
        aggregates += [
            rows.alias(f"{side}_rows"),
            (total(F.col("positives")) / rows).alias(f"{side}_positive_rate"),
            (total(F.col("score_sum")) / rows).alias(f"{side}_avg_score"),
            (total(F.col("loss")) / rows).alias(f"{side}_log_loss"),
            (total(F.col("squares")) / rows).alias(f"{side}_brier_score"),
            (total(error) / rows).alias(f"{side}_calibration_mae"),
        ]
    sides = totals.agg(*aggregates).withColumn("one", F.lit(1))
    worst = (
        calibration_drift_bins(totals)
        .agg(
            F.count(F.lit(1)).alias("bins"),
            F.max(F.abs(F.col("actual_rate_delta"))).alias("max_bin_actual_rate_delta"),
            F.max(F.abs(F.col("avg_score_delta"))).alias("max_bin_avg_score_delta"),
        )
        .withColumn("one", F.lit(1))
    )
    measures = [
        column
        for name in _MEASURES
        for column in (
            F.col(f"reference_{name}"),
            F.col(f"current_{name}"),
            (F.col(f"current_{name}") - F.col(f"reference_{name}")).alias(f"{name}_delta"),
        )
    ]
    # One row on both sides.
    return sides.join(F.broadcast(worst), "one").select(
        "reference_rows",
        "current_rows",
        "bins",
        *measures,
        "max_bin_actual_rate_delta",
        "max_bin_avg_score_delta",
    )
