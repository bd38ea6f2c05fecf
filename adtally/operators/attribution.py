"""Multi-touch attribution and campaign reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.expressions import ratio, ratio_or_zero

# Columns an attribution source must have.
REQUIRED_COLUMNS = ("campaign", "conversion", "click", "click_pos", "click_nb", "cost", "cpo")

# Default cuts of the campaign priority buckets.
SCALE_AT = 1.2
REVIEW_AT = 0.8
MIN_CONVERSIONS = 100


def check_source(df: DataFrame) -> None:
    missing = [name for name in REQUIRED_COLUMNS if name not in df.columns]
    if missing:
        raise ValueError(f"attribution source is missing required columns: {missing}")


def _converted_click() -> Column:
    return (F.col("conversion") == 1) & (F.col("click") == 1)


def last_touch_credit() -> Column:
    return F.when(_converted_click() & (F.col("click_pos") == F.col("click_nb") - 1), 1.0).otherwise(0.0)


def linear_credit() -> Column:
    return F.when(_converted_click() & (F.col("click_nb") > 0), F.lit(1.0) / F.col("click_nb")).otherwise(0.0)


def position_decay_credit(decay_rate: float = 0.5) -> Column:
    """Credit halving (by default) with every click further from the last; a path's credits sum to 1."""
    if not 0 < decay_rate <= 1:
        raise ValueError("decay_rate must be between 0 and 1")
    if decay_rate == 1.0:
        return linear_credit()
    rate = F.lit(float(decay_rate))
    clicks_after = F.greatest(F.col("click_nb") - 1 - F.col("click_pos"), F.lit(0))
    path_weight = (F.lit(1.0) - F.pow(rate, F.col("click_nb"))) / (F.lit(1.0) - rate)
    return F.when(
        _converted_click() & (F.col("click_nb") > 0), F.pow(rate, clicks_after) / path_weight
    ).otherwise(0.0)


def with_credits(df: DataFrame, decay_rate: float = 0.5) -> DataFrame:
    return df.withColumns(
        {
            "last_touch": last_touch_credit(),
            "multi_touch_linear": linear_credit(),
            "time_decay": position_decay_credit(decay_rate),
        }
    )


def campaign_report(df: DataFrame, *, decay_rate: float = 0.5) -> DataFrame:
    """One row per campaign: volumes, three attributed credits and ratios. Rows without campaign are left out."""
    check_source(df)
    volumes = (
        with_credits(df.select(*REQUIRED_COLUMNS).filter(F.col("campaign").isNotNull()), decay_rate)
        .groupBy("campaign")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("click").alias("clicks"),
            F.sum("conversion").alias("conversions"),
            F.sum("cost").alias("total_cost"),
            F.avg("cost").alias("mean_cost"),
            F.avg("cpo").alias("mean_cpo"),
            F.avg("click").alias("ctr"),
            F.sum("last_touch").alias("last_touch"),
            F.sum("multi_touch_linear").alias("multi_touch_linear"),
            F.sum("time_decay").alias("time_decay"),
        )
    )
    last, linear, decay = F.col("last_touch"), F.col("multi_touch_linear"), F.col("time_decay")
    return volumes.withColumns(
        {
            "attribution_diff": linear - last,
            "time_decay_diff_vs_last_touch": decay - last,
            "time_decay_diff_vs_linear": decay - linear,
            "last_touch_share": ratio_or_zero(last, F.col("conversions")),
            "multi_touch_linear_share": ratio_or_zero(linear, F.col("conversions")),
            "time_decay_share": ratio_or_zero(decay, F.col("conversions")),
            "roi_proxy_linear": ratio_or_zero(linear, F.col("mean_cpo")),
            "roi_proxy_time_decay": ratio_or_zero(decay, F.col("mean_cpo")),
            "cost_per_click": ratio_or_zero(F.col("total_cost"), F.col("clicks")),
            "conversion_rate": ratio_or_zero(F.col("conversions"), F.col("rows")),
        }
    ).orderBy(F.desc("conversions"), F.desc("clicks"), F.asc("campaign"))


def attribution_summary(df: DataFrame, report: DataFrame | None = None, *, decay_rate: float = 0.5) -> DataFrame:
    """One row for the whole log. Row, click and conversion totals include rows without campaign."""
    report = campaign_report(df, decay_rate=decay_rate) if report is None else report
    log_totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("click"), F.lit(0)).alias("total_clicks"),
        F.coalesce(F.sum("conversion"), F.lit(0)).alias("total_conversions"),
    ).withColumn("one", F.lit(1))
    credit_totals = report.agg(
        F.count(F.lit(1)).alias("campaigns"),
        F.coalesce(F.sum("last_touch"), F.lit(0.0)).alias("total_last_touch"),
        F.coalesce(F.sum("multi_touch_linear"), F.lit(0.0)).alias("total_multi_touch_linear"),
        F.coalesce(F.sum("time_decay"), F.lit(0.0)).alias("total_time_decay"),
    ).withColumn("one", F.lit(1))
    # Both sides are one row.
    return (
        log_totals.join(F.broadcast(credit_totals), "one")
        .drop("one")
        .withColumn("time_decay_rate", F.lit(float(decay_rate)))
    )


# Columns of the decision report, in order.
DECISION_COLUMNS = [
    "campaign", "priority_bucket", "rows", "clicks", "conversions", "total_cost", "ctr", "conversion_rate",
    "last_touch", "multi_touch_linear", "time_decay", "roi_proxy_linear", "roi_proxy_time_decay",
    "roi_proxy_gap_time_decay_vs_linear", "spend_share", "click_share", "conversion_share",
    "attributed_conversion_share_time_decay", "efficiency_index_linear", "efficiency_index_time_decay",
]


def decision_report(
    report: DataFrame,
    *,
    scale_at: float = SCALE_AT,
    review_at: float = REVIEW_AT,
    min_conversions: int = MIN_CONVERSIONS,
) -> DataFrame:
    """Shares, efficiency indices and a priority bucket per campaign, best time-decay efficiency first.

    `efficiency_index_linear` divides credit per conversion by spend share, the time-decay index divides
    share by share; the two are deliberately not symmetric.
    """
    shares = {
        "spend_share": "total_cost",
        "conversion_share": "conversions",
        "click_share": "clicks",
        "attributed_conversion_share_time_decay": "time_decay",
    }
    totals = report.agg(*[F.sum(source).alias(f"all_{source}") for source in shares.values()])
    joined = report.withColumn("one", F.lit(1)).join(F.broadcast(totals.withColumn("one", F.lit(1))), "one")
    with_shares = joined.withColumns(
        {name: ratio_or_zero(F.col(source), F.col(f"all_{source}")) for name, source in shares.items()}
    )
    with_indices = with_shares.withColumns(
        {
            "efficiency_index_time_decay": ratio_or_zero(
                F.col("attributed_conversion_share_time_decay"), F.col("spend_share")
            ),
            "efficiency_index_linear": ratio_or_zero(F.col("multi_touch_linear_share"), F.col("spend_share")),
            "roi_proxy_gap_time_decay_vs_linear": F.col("roi_proxy_time_decay") - F.col("roi_proxy_linear"),
        }
    )
    enough = F.col("conversions") >= min_conversions
    index = F.col("efficiency_index_time_decay")
    bucket = (
        F.when((index >= scale_at) & enough, "scale_candidate")
        .when((index <= review_at) & enough, "review_candidate")
        .otherwise("monitor")
    )
    return (
        with_indices.withColumn("priority_bucket", bucket)
        .select(*DECISION_COLUMNS)
        .orderBy(F.desc("efficiency_index_time_decay"), F.desc("conversions"), F.asc("campaign"))
    )


def _first(df: DataFrame, view: str, n: int, *order: Column) -> DataFrame:
    """The first n rows under a view name, with their 1-based position."""
    top = df.orderBy(*order).limit(n)
    # At most n rows are left, so one window over them is small.
    position = F.row_number().over(Window.partitionBy(F.lit(view)).orderBy(*order))
    return top.withColumn("position", position).withColumn("view", F.lit(view))


def review_views(decisions: DataFrame, *, top_campaigns: int = 20) -> DataFrame:
    """Short lists for review: best scale candidates, review candidates, and the biggest spenders of all."""
    by_efficiency = (F.desc("efficiency_index_time_decay"), F.desc("conversions"), F.asc("campaign"))
    of_bucket = lambda name: decisions.filter(F.col("priority_bucket") == name)
    return (
        _first(of_bucket("scale_candidate"), "top_scale_candidates", top_campaigns, *by_efficiency)
        .unionByName(_first(of_bucket("review_candidate"), "top_review_candidates", top_campaigns, *by_efficiency))
        .unionByName(
            _first(decisions, "top_monitor_by_spend", top_campaigns, F.desc("spend_share"), F.asc("campaign"))
        )
    )


# Columns of the campaign summary, in order.
SUMMARY_COLUMNS = [
    "campaign", "rows", "clicks", "conversions", "total_cost", "ctr", "conversion_rate", "last_touch",
    "multi_touch_linear", "time_decay", "attribution_diff", "time_decay_diff_vs_last_touch",
    "time_decay_diff_vs_linear", "roi_proxy_linear", "roi_proxy_time_decay",
]


def campaign_summary(report: DataFrame) -> DataFrame:
    return report.select(*SUMMARY_COLUMNS)


def top_lists(report: DataFrame, *, top_campaigns: int = 20) -> DataFrame:
    """Top campaigns by conversions, by credit differences and by return; ties go to the lower campaign."""
    summary = campaign_summary(report)
    tie = F.asc("campaign")
    lists = [
        ("top_campaigns_by_conversions", (F.desc("conversions"), F.desc("clicks"), tie)),
        ("top_campaigns_by_diff", (F.desc("attribution_diff"), tie)),
        ("top_campaigns_by_time_decay_diff_vs_linear", (F.desc("time_decay_diff_vs_linear"), tie)),
        ("top_campaigns_by_roi_proxy_time_decay", (F.desc("roi_proxy_time_decay"), tie)),
    ]
    return reduce(
        DataFrame.unionByName, [_first(summary, view, top_campaigns, *order) for view, order in lists]
    )


def budget_means(df: DataFrame) -> DataFrame:
    """Mean credits and costs per campaign with the return proxy and the credit difference."""
    means = (
        with_credits(df.select(*REQUIRED_COLUMNS).filter(F.col("campaign").isNotNull()))
        .groupBy("campaign")
        .agg(
            F.avg("last_touch").alias("last_touch"),
            F.avg("multi_touch_linear").alias("multi_touch_linear"),
            F.avg("cpo").alias("cpo"),
            F.avg("cost").alias("cost"),
            F.avg("click").alias("ctr"),
        )
    )
    return means.withColumns(
        {
            "roi_proxy": ratio(F.col("multi_touch_linear"), F.col("cpo")),
            "diff": F.col("multi_touch_linear") - F.col("last_touch"),
        }
    )


def budget_views(df: DataFrame, *, n: int = 10) -> DataFrame:
    """Best and worst campaigns by return and by credit difference, n rows each."""
    means = budget_means(df)
    tie = F.asc("campaign")
    return reduce(
        DataFrame.unionByName,
        [
            _first(means, "top_roi", n, F.desc_nulls_last("roi_proxy"), tie),
            _first(means, "bottom_roi", n, F.asc_nulls_last("roi_proxy"), tie),
            _first(means, "top_diff", n, F.desc("diff"), tie),
            _first(means, "bottom_diff", n, F.asc("diff"), tie),
        ],
    )
