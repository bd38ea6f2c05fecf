"""Quality of scores: ranking, probability error, calibration, lift, and the same per slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.binning import with_right_closed_bin
from adtally.functions.expressions import clipped_probability, ratio
from adtally.operators.contracts import check_scored
from adtally.operators.ranking import ROWS_PER_BUCKET, value_buckets, with_bucket
from adtally.operators.selection import quantile_edges
from adtally.operators.splits import TIME_KEY, with_time_slice
from adtally.sources.staging import stage


def binary_metrics(
    df: DataFrame,
    *,
    label_col: str,
    score_col: str,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """rows, positive_rate, avg_score, roc_auc, pr_auc, log_loss and brier_score, overall or per group.

    Rows are first summed per distinct score, so ties collapse before the shuffle. Running totals are taken
    inside score buckets and completed by the totals of the higher buckets: a group holding most of the rows
    is spread over all its buckets. Both areas are null when a group has one class only. Rows without a label
    or a score are refused.
    """
    by = list(by)
    check_scored(df, label_col, score_col)
    score, label = F.col(score_col).cast("double"), F.col(label_col).cast("double")
    work = df.select(*by, score.alias("__score"), label.alias("__y"))
    buckets = value_buckets(work, {"score": F.col("__score")}, rows_per_bucket=rows_per_bucket)["score"]
    per_score = (
        with_bucket(work, F.col("__score"), buckets, "__bucket")
        .groupBy(*by, "__bucket", "__score")
        .agg(F.sum("__y").alias("p"), F.sum(1.0 - F.col("__y")).alias("q"))
    )
    higher = Window.partitionBy(*by, F.lit(0)).orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    above = (
        per_score.groupBy(*by, "__bucket")
        .agg(F.sum("p").alias("bucket_p"), F.sum("q").alias("bucket_q"))
        .select(
            *[F.col(name).alias(f"__above_{name}") for name in by],
            F.col("__bucket").alias("__above_bucket"),
            F.coalesce(F.sum("bucket_p").over(higher), F.lit(0.0)).alias("p_above"),
            F.coalesce(F.sum("bucket_q").over(higher), F.lit(0.0)).alias("q_above"),
        )
    )
    # One row per group and bucket, written so that the planner sees its size: it is broadcast when small
    # enough for the session's broadcast limit and joined by shuffle otherwise.
    above = stage(above, "score-totals")
    same = F.col("__bucket") == F.col("__above_bucket")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"__above_{name}"))
    within = (
        Window.partitionBy(*by, "__bucket")
        .orderBy(F.desc("__score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    curve = per_score.join(above, same).withColumns(
        {"tp": F.col("p_above") + F.sum("p").over(within), "fp": F.col("q_above") + F.sum("q").over(within)}
    )
    s, p, q = F.col("__score"), F.col("p"), F.col("q")
    prob = clipped_probability(s)
    sums = curve.groupBy(*by).agg(
        F.sum(p).alias("positives"),
        F.sum(q).alias("negatives"),
        F.sum(s * (p + q)).alias("score_sum"),
        F.sum(q * (F.col("tp") - p / 2.0)).alias("pairs"),
        F.sum(p * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision_sum"),
        F.sum(-(p * F.ln(prob) + q * F.ln(1.0 - prob))).alias("loss"),
        F.sum(p * F.pow(1.0 - s, F.lit(2)) + q * F.pow(s, F.lit(2))).alias("squares"),
    )
    rows = F.col("positives") + F.col("negatives")
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return sums.select(
        *by,
        rows.cast("long").alias("rows"),
        (F.col("positives") / rows).alias("positive_rate"),
        (F.col("score_sum") / rows).alias("avg_score"),
        F.when(both, F.col("pairs") / (F.col("positives") * F.col("negatives"))).alias("roc_auc"),
        F.when(both, F.col("precision_sum") / F.col("positives")).alias("pr_auc"),
        (F.col("loss") / rows).alias("log_loss"),
        (F.col("squares") / rows).alias("brier_score"),
    )


def calibration_bins(df: DataFrame, *, label_col: str, score_col: str, bins: int = 10) -> DataFrame:
    """Equally filled score bins, best score first: rows, positives, mean score, actual rate and lift.

    A constant score gives one bin.
    """
    work = df.select(F.col(score_col).cast("double").alias("score"), F.col(label_col).cast("double").alias("y"))
    edges = quantile_edges(work, {"score": F.col("score")}, bins=bins, limit_bins_to_rows=True)["score"]
    grouped = (
        with_right_closed_bin(work, {"bin": (F.col("score"), edges[1:-1])})
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("y").alias("positives"),
            F.avg("score").alias("avg_score"),
            F.avg("y").alias("actual_rate"),
        )
    )
    # At most `bins` rows from here on.
    everything = Window.partitionBy(F.lit(0))
    base_rate = F.sum("positives").over(everything) / F.sum("rows").over(everything)
    return grouped.select(
        F.col("bin").cast("long").alias("bin"),
        F.row_number().over(everything.orderBy(F.desc("avg_score"))).alias("rank_by_score"),
        "rows",
        "positives",
        "avg_score",
        "actual_rate",
        ratio(F.col("actual_rate"), base_rate).alias("lift_vs_baseline"),
    )


def calibration_summary(bin_rows: DataFrame) -> DataFrame:
    """Base rate, unweighted mean calibration error over bins, and lift of the best and the worst bin."""
    return bin_rows.agg(
        (F.sum("positives") / F.sum("rows")).alias("baseline_positive_rate"),
        F.avg(F.abs(F.col("avg_score") - F.col("actual_rate"))).alias("calibration_bin_mae"),
        F.min_by("lift_vs_baseline", "rank_by_score").alias("top_bin_lift"),
        F.max_by("lift_vs_baseline", "rank_by_score").alias("bottom_bin_lift"),
    )


def top_groups(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent non-null values; ties go to the smaller value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(n)


def campaign_slices(
    df: DataFrame, *, label_col: str, score_col: str, campaign_col: str = "campaign", top_campaigns: int = 10
) -> DataFrame:
    """Metrics of the most frequent campaigns, biggest first."""
    # At most `top_campaigns` rows are broadcast.
    chosen = F.broadcast(top_groups(df, campaign_col, top_campaigns).select(campaign_col))
    rows = df.select(campaign_col, label_col, score_col).join(chosen, campaign_col, "left_semi")
    metrics = binary_metrics(rows, label_col=label_col, score_col=score_col, by=[campaign_col])
    return (
        metrics.withColumn("group", F.col(campaign_col).cast("string"))
        .orderBy(F.desc("rows"), F.asc(campaign_col))
        .drop(campaign_col)
    )


def time_slices(
    df: DataFrame,
    *,
    label_col: str,
    score_col: str,
    timestamp_col: str = "timestamp",
    slices: int = 5,
    order: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Metrics and time range of equally filled slices of the time order."""
    sliced = with_time_slice(df, slices=slices, order=order).select("time_slice", timestamp_col, label_col, score_col)
    metrics = binary_metrics(sliced, label_col=label_col, score_col=score_col, by=["time_slice"])
    ranges = sliced.groupBy("time_slice").agg(
        F.min(timestamp_col).cast("double").alias("timestamp_min"),
        F.max(timestamp_col).cast("double").alias("timestamp_max"),
    )
    # One row per slice on both sides.
    return (
        metrics.join(F.broadcast(ranges), "time_slice")
        .withColumn("group", F.concat(F.lit("slice_"), F.col("time_slice").cast("string")))
        .orderBy("time_slice")
    )
