"""Benchmark columns with a known treatment effect, drawn reproducibly from a hash of the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.expressions import clip, hash_uniform
from adtally.operators.ranking import with_average_ranks
from adtally.operators.splits import TIME_KEY


def add_known_effect_columns(
    df: DataFrame,
    *,
    treatment_col: str = "synthetic_treatment",
    outcome_col: str = "synthetic_outcome",
    true_effect_col: str = "true_treatment_effect",
    seed: int = 42,
    key: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Adds treatment, outcome, true effect, propensity, outcome probability and its untreated baseline.

    Ranks use the log columns when present. A draw depends on seed and row key only, so retries, partition
    counts and row order cannot change it.
    """
    names = df.columns
    recency = F.col("time_since_last_click")
    sources = {
        "bench_cost": F.col("log_cost" if "log_cost" in names else "cost"),
        "bench_cpo": F.col("log_cpo" if "log_cpo" in names else "cpo"),
        "bench_recency": F.col("log_time_since_last_click")
        if "log_time_since_last_click" in names
        else F.greatest(recency, F.lit(0)),
    }
    ranked = with_average_ranks(df, sources)
    cost, cpo, rec = (F.coalesce(F.col(name), F.lit(0.5)) for name in sources)
    clicked_before = F.coalesce(recency >= 0, F.lit(False)).cast("int")
    previous = F.col("has_prev_click") if "has_prev_click" in names else clicked_before
    treated = (hash_uniform(seed, key, "t") < F.col(f"{treatment_col}_propensity")).cast("int")
    converted = (hash_uniform(seed, key, "y") < F.col(f"{outcome_col}_probability")).cast("int")
    return (
        # Coefficients and limits of the benchmark's effect, propensity and baseline.
        ranked.withColumn(true_effect_col, clip(0.02 + 0.16 * cpo + 0.06 * previous - 0.04 * rec, 0.01, 0.25))
        .withColumn(f"{treatment_col}_propensity", clip(0.15 + 0.55 * cost + 0.15 * previous, 0.05, 0.95))
        .withColumn("baseline_outcome_probability", clip(0.06 + 0.20 * cost + 0.10 * (1.0 - rec), 0.02, 0.70))
        .withColumn(treatment_col, treated)
        .withColumn(
            f"{outcome_col}_probability",
            clip(
                F.col("baseline_outcome_probability") + F.col(treatment_col) * F.col(true_effect_col), 0.0, 0.95
            ),
        )
        .withColumn(outcome_col, converted)
        .drop(*sources)
    )
