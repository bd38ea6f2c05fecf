"""Reports over the best-scored share of the rows.

All share sizes of all orderings come from one pass: rank cuts label every row with the smallest selection
that holds it (its tier), rows are summed per tier, and a selection is the sum of its tiers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.expressions import add_all, correlation, descending, ratio
from adtally.operators.contracts import check_fraction, check_present
from adtally.operators.ranking import with_average_ranks, with_row_number
from adtally.operators.selection import Ordering, first_k, rank_cuts
from adtally.operators.splits import TIME_KEY, random_order, with_random_draw

FRACTIONS = (0.01, 0.05, 0.1, 0.2, 0.3)


def best_first(score_col: str, key: Sequence[str] = TIME_KEY) -> list[Column]:
    """Sort keys for highest score first, nulls last, ties in time order."""
    return [descending(F.col(score_col)), *[F.col(name) for name in key]]


def _selections(
    df: DataFrame,
    orders: Mapping[str, tuple[list[Column], Column]],
    fractions: Sequence[float],
    sums: Mapping[str, Column],
    rows: int,
) -> DataFrame:
    """Sums per (name, position of the fraction); position len(fractions) covers all rows.

    `orders` maps a name to its sort keys and the score to average.
    """
    sizes = [first_k(rows, fraction) for fraction in fractions]
    by_size = sorted(set(sizes))
    cuts = rank_cuts(df, [Ordering(keys, by_size, rows=rows) for keys, _ in orders.values()])
    pieces = []
    for (name, (_, score)), found in zip(orders.items(), cuts, strict=True):
        tier = add_all([(~found[size]).cast("int") for size in by_size])
        pieces += [F.lit(name), score.cast("double"), tier]
    long = df.select(
        *[column.cast("double").alias(name) for name, column in sums.items()],
        F.stack(F.lit(len(orders)), *pieces).alias("name", "score", "tier"),
    )
    tiers = long.groupBy("name", "tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("score_n"),
        *[F.sum(name).alias(name) for name in sums],
    )
    # (names x tiers) rows are left. A tier belongs to every selection at least as large.
    holders = [
        F.when(F.col("tier") <= by_size.index(size), F.lit(i)) for i, size in enumerate(sizes)
    ] + [F.lit(len(sizes))]
    spread = tiers.withColumn("position", F.explode(F.array_compact(F.array(*holders))))
    names = ["n", "score_sum", "score_n", *sums]
    return spread.groupBy("name", "position").agg(*[F.sum(name).alias(name) for name in names])


def _fraction(fractions: Sequence[float]) -> Column:
    return F.element_at(F.array(*[F.lit(float(f)) for f in [*fractions, 1.0]]), F.col("position") + 1)


def _whole(name: str, fractions: Sequence[float], window) -> Column:
    return F.max(F.when(F.col("position") == len(fractions), F.col(name))).over(window)


def ranking_diagnostics(
    df: DataFrame,
    *,
    score_cols: Sequence[str],
    treatment_col: str,
    outcome_col: str,
    top_fraction: float = 0.1,
    key: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Best against worst share per score: rows, mean score, outcome rate and treatment rate."""
    check_fraction(top_fraction, name="top_fraction", below=0.5)
    rows = df.count()
    k = first_k(rows, top_fraction)
    cuts = rank_cuts(df, [Ordering(best_first(name, key), [k, rows - k], rows=rows) for name in score_cols])
    pieces = []
    for name, found in zip(score_cols, cuts, strict=True):
        pieces += [F.lit(name), F.col(name).cast("double"), found[k], ~found[rows - k]]
    long = df.select(
        F.col(treatment_col).alias("t"),
        F.col(outcome_col).alias("y"),
        F.stack(F.lit(len(score_cols)), *pieces).alias("score_col", "score", "top", "bottom"),
    )
    aggregates = [F.count(F.lit(1)).cast("double").alias("rows")]
    aggregates += [F.count_if(F.col(end)).cast("double").alias(f"{end}_rows") for end in ("top", "bottom")]
    for source, suffix in (("score", "mean_score"), ("y", "observed_conversion_rate"), ("t", "treatment_rate")):
        aggregates += [F.avg(F.when(F.col(end), F.col(source))).alias(f"{end}_{suffix}") for end in ("top", "bottom")]
    return long.groupBy("score_col").agg(*aggregates)


def policy_curve(
    df: DataFrame,
    *,
    score_cols: Sequence[str],
    treatment_col: str,
    outcome_col: str,
    fractions: Sequence[float] = FRACTIONS,
    key: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Per score and top fraction: outcome rate, lift, treatment rate and the treated-control gap."""
    for fraction in fractions:
        check_fraction(fraction, name="top_fractions")
    t, y = F.col(treatment_col), F.col(outcome_col)
    sums = {
        "y": y,
        "t": t,
        "y_treated": F.when(t == 1, y).otherwise(0),
        "n_treated": (t == 1).cast("int"),
        "y_control": F.when(t == 0, y).otherwise(0),
        "n_control": (t == 0).cast("int"),
    }
    orders = {name: (best_first(name, key), F.col(name)) for name in score_cols}
    chosen = _selections(df, orders, fractions, sums, df.count())
    per_score = Window.partitionBy("name")
    base_rate = _whole("y", fractions, per_score) / _whole("n", fractions, per_score)
    base_treated = _whole("t", fractions, per_score) / _whole("n", fractions, per_score)
    return (
        chosen.select(
            F.col("name").alias("score_col"),
            _fraction(fractions).alias("top_fraction"),
            F.col("n").cast("double").alias("rows"),
            ratio(F.col("score_sum"), F.col("score_n")).alias("mean_score"),
            (F.col("y") / F.col("n")).alias("observed_outcome_rate"),
            base_rate.alias("baseline_outcome_rate"),
            ratio(F.col("y") / F.col("n"), base_rate).alias("outcome_rate_lift"),
            (F.col("t") / F.col("n")).alias("treatment_rate"),
            base_treated.alias("baseline_treatment_rate"),
            ratio(F.col("y_treated"), F.col("n_treated")).alias("treated_outcome_rate"),
            ratio(F.col("y_control"), F.col("n_control")).alias("control_outcome_rate"),
            "position",
        )
        .filter(F.col("position") < len(fractions))
        .drop("position")
        .withColumn("observed_treated_control_gap", F.col("treated_outcome_rate") - F.col("control_outcome_rate"))
    )


def known_effect_report(
    df: DataFrame,
    *,
    score_cols: Sequence[str],
    true_effect_col: str,
    fractions: Sequence[float] = FRACTIONS,
    key: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Rank and linear correlation with the true effect, and the true effect found in every top fraction.

    The extra score `oracle_true_effect` orders by the true effect itself.
    """
    for fraction in fractions:
        check_fraction(fraction, name="top_fractions")
    oracle = "oracle_true_effect"
    effect = F.col(true_effect_col)
    orders = {name: (best_first(name, key), F.col(name)) for name in score_cols}
    orders[oracle] = (best_first(true_effect_col, key), F.lit(None).cast("double"))
    chosen = _selections(df, orders, fractions, {"effect": effect}, df.count())

    columns = {f"rank_{i}": F.col(name) for i, name in enumerate(score_cols)} | {"rank_effect": effect}
    ranked = with_average_ranks(df.select(*score_cols, true_effect_col), columns, as_share=False)
    correlations = ranked.agg(
        *[correlation(f"rank_{i}", "rank_effect").alias(f"s{i}") for i in range(len(score_cols))],
        *[correlation(name, true_effect_col).alias(f"p{i}") for i, name in enumerate(score_cols)],
    )
    pieces = []
    for i, name in enumerate(score_cols):
        pieces += [F.lit(name), F.col(f"s{i}"), F.col(f"p{i}")]
    pieces += [F.lit(oracle), F.lit(1.0), F.lit(1.0)]
    per_name = correlations.select(F.stack(F.lit(len(orders)), *pieces).alias("name", "spearman", "pearson"))

    base = _whole("effect", fractions, Window.partitionBy("name")) / _whole("n", fractions, Window.partitionBy("name"))
    found = F.col("effect") / F.col("n")
    return (
        # One row per score.
        chosen.join(F.broadcast(per_name), "name")
        .select(
            F.col("name").alias("score_col"),
            _fraction(fractions).alias("top_fraction"),
            F.col("spearman").alias("spearman_corr_with_true_effect"),
            F.col("pearson").alias("pearson_corr_with_true_effect"),
            F.col("n").cast("double").alias("rows"),
            ratio(F.col("score_sum"), F.col("score_n")).alias("mean_score"),
            found.alias("mean_true_effect"),
            base.alias("baseline_true_effect"),
            F.when(base > 0, found / base).alias("true_effect_lift"),
            "position",
        )
        .filter(F.col("position") < len(fractions))
        .drop("position")
    )


def score_correlation(df: DataFrame, first: str, second: str) -> DataFrame:
    """Linear correlation of two scores; null when undefined."""
    return df.agg(correlation(first, second).alias("correlation"))


def policy_table(
    df: DataFrame,
    *,
    score_cols: Sequence[str],
    fractions: Sequence[float],
    outcome_col: str,
    treatment_col: str,
    true_effect_col: str | None = None,
    seed: int = 42,
    key: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Every targeting policy at every budget: all rows, a seeded random draw, the oracle, the top scores."""
    check_present(df, score_cols, "policy score columns are missing from input")
    for fraction in fractions:
        check_fraction(fraction, name="top_fractions")
    rows = df.count()
    if not rows:
        raise ValueError("policy simulation requires at least one row")
    no_score = F.lit(None).cast("double")
    orders = {"random_policy": (random_order(key), no_score)}
    score_names = {"random_policy": None}
    if true_effect_col is not None:
        orders["oracle_true_effect"] = (best_first(true_effect_col, key), F.col(true_effect_col))
        score_names["oracle_true_effect"] = true_effect_col
    for name in score_cols:
        orders[f"top_{name}"] = (best_first(name, key), F.col(name))
        score_names[f"top_{name}"] = name
    sums = {"y": F.col(outcome_col), "t": F.col(treatment_col)}
    if true_effect_col is not None:
        sums["effect"] = F.col(true_effect_col)
    chosen = _selections(with_random_draw(df, seed, key), orders, fractions, sums, rows)

    # Policies x fractions rows from here on.
    whole = F.col("position") == len(fractions)
    chosen = chosen.filter(~whole | (F.col("name") == "random_policy"))
    everything = Window.partitionBy(F.lit(0))
    base = {name: _whole(name, fractions, everything) for name in ["n", *sums]}
    score_name = reduce(
        lambda column, item: column.when(F.col("name") == item[0], F.lit(item[1])),
        list(score_names.items())[1:],
        F.when(whole, F.lit(None).cast("string")),
    )
    n = F.col("n")
    columns = {
        "policy_name": F.when(whole, "all_rows").otherwise(F.col("name")),
        "score_col": score_name,
        "top_fraction": _fraction(fractions),
        "selected_rows": n,
        "selected_share": n / base["n"],
        "mean_score": ratio(F.col("score_sum"), F.col("score_n")),
        "observed_outcome_rate": F.col("y") / n,
        "baseline_outcome_rate": base["y"] / base["n"],
        "observed_outcome_lift": ratio(F.col("y") / n, base["y"] / base["n"]),
        "treatment_rate": F.col("t") / n,
        "baseline_treatment_rate": base["t"] / base["n"],
    }
    if true_effect_col is not None:
        columns |= {
            "mean_true_effect": F.col("effect") / n,
            "baseline_true_effect": base["effect"] / base["n"],
            "true_effect_lift": ratio(F.col("effect") / n, base["effect"] / base["n"]),
            "expected_incremental_conversions": F.col("effect"),
            "expected_incremental_conversions_per_1k_selected": F.col("effect") / n * 1000.0,
        }
    table = chosen.select(*[column.alias(name) for name, column in columns.items()])
    return table if true_effect_col is None else with_oracle_regret(table)


def with_oracle_regret(policies: DataFrame) -> DataFrame:
    """The oracle's expected conversions at the same budget and the distance to them; null without an oracle row.

    Budgets are compared as the very numbers passed in, never as computed ones.
    """
    same_budget = Window.partitionBy("top_fraction")
    best = F.max(
        F.when(F.col("policy_name") == "oracle_true_effect", F.col("expected_incremental_conversions"))
    ).over(same_budget)
    return policies.withColumn("oracle_expected_incremental_conversions", best).withColumn(
        "oracle_regret_incremental_conversions",
        F.col("oracle_expected_incremental_conversions") - F.col("expected_incremental_conversions"),
    )


# Effect columns a policy table has only when a true effect is known.
_EFFECT_COLUMNS = (
    "mean_true_effect", "true_effect_lift", "expected_incremental_conversions",
    "expected_incremental_conversions_per_1k_selected", "oracle_regret_incremental_conversions",
)


def policy_comparison(policies: DataFrame, *, preferred_score_col: str) -> DataFrame:
    """The preferred policy at every budget against the random draw and the oracle."""
    preferred = f"top_{preferred_score_col}"
    if policies.filter(F.col("policy_name") == preferred).isEmpty():
        raise ValueError(f"preferred policy is missing from simulation report: {preferred}")
    for name in _EFFECT_COLUMNS:
        if name not in policies.columns:
            policies = policies.withColumn(name, F.lit(None).cast("double"))
    own = F.col("expected_incremental_conversions")
    same_budget = Window.partitionBy("top_fraction")
    of = lambda policy: F.max(F.when(F.col("policy_name") == policy, own)).over(same_budget)
    return (
        policies.withColumns(
            {
                "random_expected_incremental_conversions": of("random_policy"),
                "oracle_expected_incremental_conversions": of("oracle_true_effect"),
            }
        )
        .filter(F.col("policy_name") == preferred)
        .select(
            "policy_name",
            F.lit(preferred_score_col).alias("score_col"),
            "top_fraction",
            "selected_rows",
            "mean_true_effect",
            "true_effect_lift",
            "expected_incremental_conversions",
            "expected_incremental_conversions_per_1k_selected",
            "random_expected_incremental_conversions",
            "oracle_expected_incremental_conversions",
            (own - F.col("random_expected_incremental_conversions")).alias("incremental_conversions_vs_random"),
            "oracle_regret_incremental_conversions",
            ratio(own, F.col("oracle_expected_incremental_conversions")).alias("oracle_capture_rate"),
        )
        .orderBy("top_fraction")
    )


def policy_recommendation(comparison: DataFrame, *, recommended_top_fraction: float | None = None) -> DataFrame:
    """One row: the budget nearest to the request, the most efficient and the best-capturing budget."""
    target = 0.1 if recommended_top_fraction is None else float(recommended_top_fraction)
    # One row per budget, so each pick is a small aggregate. Ties go to the smaller budget.
    smaller = -F.col("top_fraction")
    nearest = F.struct(-F.abs(F.col("top_fraction") - F.lit(target)), smaller)
    efficient = F.struct(F.col("expected_incremental_conversions_per_1k_selected"), smaller)
    capturing = F.struct(F.col("oracle_capture_rate"), smaller)
    pick = lambda name, by, alias: F.max_by(name, by).alias(alias)
    per_1k = "expected_incremental_conversions_per_1k_selected"
    return comparison.agg(
        pick("policy_name", nearest, "recommended_policy_name"),
        pick("score_col", nearest, "recommended_score_col"),
        pick("top_fraction", nearest, "recommended_top_fraction"),
        pick("selected_rows", nearest, "recommended_selected_rows"),
        pick("expected_incremental_conversions", nearest, "recommended_expected_incremental_conversions"),
        pick("incremental_conversions_vs_random", nearest, "recommended_incremental_conversions_vs_random"),
        pick("oracle_capture_rate", nearest, "recommended_oracle_capture_rate"),
        pick("oracle_regret_incremental_conversions", nearest, "recommended_oracle_regret_incremental_conversions"),
        pick("top_fraction", efficient, "highest_efficiency_top_fraction"),
        pick(per_1k, efficient, "highest_efficiency_incremental_conversions_per_1k_selected"),
        pick("top_fraction", capturing, "highest_oracle_capture_top_fraction"),
        pick("oracle_capture_rate", capturing, "highest_oracle_capture_rate"),
    )


def batch_scores(
    df: DataFrame,
    *,
    id_columns: Sequence[str],
    score_cols: Sequence[str],
    preferred_score_col: str,
    recommended_top_fraction: float,
    optional_columns: Sequence[str] = (),
    key: Sequence[str] = TIME_KEY,
) -> DataFrame:
    """Every row with its scores, its rank by the preferred score, its percentile and the targeting flag.

    Equal scores are ranked in time order. Rows come in rank order, range-partitioned and sorted.
    """
    check_fraction(recommended_top_fraction, name="recommended_top_fraction")
    check_present(df, id_columns, "batch score input is missing id columns")
    check_present(df, score_cols, "batch score input is missing score columns")
    check_present(df, [preferred_score_col], "preferred_score_col is missing from score columns")
    shown = [*id_columns]
    shown += [name for name in optional_columns if name in df.columns and name not in shown]
    output = list(dict.fromkeys([*shown, *score_cols]))
    work = df.select(*dict.fromkeys([*output, preferred_score_col, *key]))
    if not work.filter(F.col(preferred_score_col).isNull()).isEmpty():
        raise ValueError(f"{preferred_score_col} contains null scores that cannot be ranked")
    order = [F.desc(preferred_score_col), *[F.asc(name) for name in key]]
    rows = df.count()
    ranked = with_row_number(work, order, "policy_score_rank", rows=rows)
    rank = F.col("policy_score_rank")
    return ranked.select(
        *output,
        F.lit(preferred_score_col).alias("policy_score_col"),
        rank,
        (F.lit(1.0) - (rank - 1) / F.lit(float(max(rows, 1)))).alias("policy_score_percentile"),
        F.lit(float(recommended_top_fraction)).alias("recommended_top_fraction"),
        (rank <= first_k(rows, recommended_top_fraction)).cast("int").alias("recommended_policy"),
    ).orderBy("policy_score_rank")


def batch_summary(scored: DataFrame, *, preferred_score_col: str, true_effect_col: str | None = None) -> DataFrame:
    """One row: volumes, mean scores and, with a known effect, the conversions the selection should add."""
    chosen = F.col("recommended_policy") == 1
    selected = F.count_if(chosen)
    aggregates = [
        F.count(F.lit(1)).alias("rows"),
        selected.alias("recommended_rows"),
        F.coalesce(ratio(selected, F.count(F.lit(1))), F.lit(0.0)).alias("recommended_share"),
        F.first("policy_score_col").alias("preferred_score_col"),
        F.first("recommended_top_fraction").alias("recommended_top_fraction"),
        F.avg(preferred_score_col).alias("mean_preferred_score"),
        F.avg(F.when(chosen, F.col(preferred_score_col))).alias("recommended_mean_preferred_score"),
    ]
    if true_effect_col is not None and true_effect_col in scored.columns:
        effect = F.col(true_effect_col)
        added = F.sum(F.when(chosen, effect))
        aggregates += [
            F.avg(effect).alias("mean_true_effect"),
            F.avg(F.when(chosen, effect)).alias("recommended_mean_true_effect"),
            added.alias("recommended_expected_incremental_conversions"),
            (ratio(added, selected) * 1000.0).alias("recommended_expected_incremental_conversions_per_1k"),
        ]
    return scored.agg(*aggregates)


def cumulative_gain(
    df: DataFrame, *, score_col: str, outcome_col: str, keep: Sequence[str] = TIME_KEY, key: Sequence[str] = TIME_KEY
) -> DataFrame:
    """Rows in order of falling score with their position and the outcomes gathered so far."""
    work = df.select(*dict.fromkeys([*keep, *key, score_col, outcome_col]))
    order = [F.desc_nulls_last(score_col), *[F.asc(name) for name in key]]
    return with_row_number(work, order, "position", running={"cumulative_outcomes": F.col(outcome_col)})
