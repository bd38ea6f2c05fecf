"""Row-wise and rank features of the ad log, and the named feature sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.expressions import bin_index
from adtally.operators.ranking import with_average_ranks

# Right-closed upper ends of the recency buckets 0..3, in seconds.
RECENCY_EDGES = (0.5, 3600.0, 86400.0, 604800.0)
NO_PREVIOUS_CLICK = -1


def _cleaned_recency() -> Column:
    recency = F.col("time_since_last_click").cast("double")
    return F.when(recency != NO_PREVIOUS_CLICK, recency)


def add_log_costs(df: DataFrame) -> DataFrame:
    return df.withColumns({"log_cost": F.log1p("cost"), "log_cpo": F.log1p("cpo")})


def add_recency_flags(df: DataFrame) -> DataFrame:
    """Replaces the 'none' marker by null and adds the 0/1 flag of a previous click."""
    return df.withColumns(
        {"time_since_last_click": _cleaned_recency(), "has_prev_click": _cleaned_recency().isNotNull().cast("int")}
    )


def add_recency_transforms(df: DataFrame) -> DataFrame:
    """Log recency and recency bucket; a row without previous click counts as recency 0."""
    filled = F.coalesce(_cleaned_recency(), F.lit(0.0))
    return df.withColumns(
        {"log_time_since_last_click": F.log1p(filled), "recency_bucket": bin_index(filled, RECENCY_EDGES).cast("int")}
    )


def add_rank_features(df: DataFrame) -> DataFrame:
    """Average rank over the whole table divided by the non-null count, for cost, cpo and recency."""
    recency = F.greatest(F.coalesce(F.col("time_since_last_click").cast("double"), F.lit(0.0)), F.lit(0.0))
    return with_average_ranks(
        df, {"cost_rank": F.col("cost"), "cpo_rank": F.col("cpo"), "recency_rank": recency}
    )


def _click_features(df: DataFrame) -> DataFrame:
    return df.transform(add_log_costs).transform(add_recency_flags)


def _click_features_with_buckets(df: DataFrame) -> DataFrame:
    return df.transform(_click_features).transform(add_recency_transforms)


def _rank_features(df: DataFrame) -> DataFrame:
    return df.transform(_click_features_with_buckets).transform(add_rank_features)


FEATURE_SETS = {
    "ctr_notebook_v1": _click_features,
    "ctr_notebook_v2": _click_features_with_buckets,
    "semisynthetic_rank_v1": _rank_features,
}


def apply_feature_set(df: DataFrame, name: str | None) -> DataFrame:
    """Add a named feature set; None or 'none' changes nothing."""
    if name is None or name == "none":
        return df
    if name not in FEATURE_SETS:
        raise ValueError(f"Unsupported feature_builder: {name}")
    return df.transform(FEATURE_SETS[name])


def expected_value_top(df: DataFrame, *, score_col: str, value_col: str = "cpo", n: int = 20) -> DataFrame:
    """The n rows with the highest score times value."""
    ranked = df.withColumn("expected_value", F.col(score_col) * F.col(value_col))
    return ranked.orderBy(F.desc_nulls_last("expected_value"), "timestamp", "uid", "campaign").limit(n)
