import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adtally.operators import targeting as T
from adtally.operators.splits import random_selection

KEY = ["timestamp", "uid", "campaign"]


def batch_input(spark):
    rows = [(1, 10, 100, 0.1, 0.2, 0.1), (2, 20, 100, 0.4, 0.6, 0.9), (3, 30, 101, 0.2, 0.1, 0.2), (4, 40, 101, 0.3, 0.5, 0.8)]
    return spark.createDataFrame(
        rows,
        "uid long, timestamp long, campaign long, true_treatment_effect double, observational_score double, "
        "doubly_robust_score double",
    )


def batch(df, fraction=0.5, **options):
    return T.batch_scores(
        df, id_columns=["uid", "timestamp", "campaign"], score_cols=["observational_score", "doubly_robust_score"],
        preferred_score_col="doubly_robust_score", recommended_top_fraction=fraction,
        optional_columns=["true_treatment_effect", "absent"], **options,
    )


def test_batch_scores(spark):
    scored = batch(batch_input(spark))
    rows = scored.orderBy("policy_score_rank").collect()
    assert [r.uid for r in rows] == [2, 4, 3, 1]
    assert [r.policy_score_rank for r in rows] == [1, 2, 3, 4]
    assert [r.recommended_policy for r in rows] == [1, 1, 0, 0]
    assert [r.policy_score_percentile for r in rows] == [1.0, 0.75, 0.5, 0.25]
    assert scored.columns[:6] == [
        "uid", "timestamp", "campaign", "true_treatment_effect", "observational_score", "doubly_robust_score"
    ]
    summary = T.batch_summary(
        scored, preferred_score_col="doubly_robust_score", true_effect_col="true_treatment_effect"
    ).first()
    assert (summary.rows, summary.recommended_rows, summary.recommended_share) == (4, 2, 0.5)
    assert summary.recommended_expected_incremental_conversions == pytest.approx(0.7)
    assert summary.recommended_expected_incremental_conversions_per_1k == pytest.approx(350.0)


def test_batch_input_errors(spark):
    df = batch_input(spark)
    with pytest.raises(ValueError, match="recommended_top_fraction must be between 0 and 1"):
        batch(df, fraction=0)
    with pytest.raises(ValueError, match="missing id columns"):
        batch(df.drop("uid"))
    with pytest.raises(ValueError, match="null scores"):
        batch(df.withColumn("doubly_robust_score", F.lit(None).cast("double")))


def test_equal_scores_rank_in_time_order(spark):
    rows = batch(batch_input(spark).withColumn("doubly_robust_score", F.lit(0.5))).orderBy("policy_score_rank").collect()
    assert [r.uid for r in rows] == [1, 2, 3, 4]


def frame(spark, rows=700):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(
        {
            "timestamp": np.arange(rows), "uid": rng.integers(0, 9, rows), "campaign": 1,
            # a third of the rows share one score and some have none
            "a": np.where(rng.random(rows) < 0.34, 0.5, rng.random(rows)),
            "b": np.where(rng.random(rows) < 0.2, np.nan, rng.random(rows)),
            "t": rng.integers(0, 2, rows), "y": rng.integers(0, 2, rows), "e": rng.random(rows).round(1),
        }
    )
    return pdf, spark.createDataFrame(pdf).withColumn("b", F.when(~F.isnan("b"), F.col("b"))).repartition(5)


def top(pdf, column, k):
    return pdf.sort_values([column, *KEY], ascending=[False, True, True, True], na_position="last").head(k)


FRACTIONS = (0.001, 0.05, 0.5, 0.9, 1.0)


def test_ranking_diagnostics(spark):
    pdf, df = frame(spark)
    rows = T.ranking_diagnostics(df, score_cols=["a", "b"], treatment_col="t", outcome_col="y", top_fraction=0.3)
    for row in rows.collect():
        k = int(len(pdf) * 0.3)
        ordered = top(pdf, row.score_col, len(pdf))
        for end, part in (("top", ordered.head(k)), ("bottom", ordered.tail(k))):
            assert row[f"{end}_rows"] == k
            assert row[f"{end}_mean_score"] == pytest.approx(part[row.score_col].mean())
            assert row[f"{end}_observed_conversion_rate"] == pytest.approx(part.y.mean())
            assert row[f"{end}_treatment_rate"] == pytest.approx(part.t.mean())
    with pytest.raises(ValueError, match="between 0 and 0.5"):
        T.ranking_diagnostics(df, score_cols=["a"], treatment_col="t", outcome_col="y", top_fraction=0.5)


def test_single_row_is_top_and_bottom(spark):
    pdf, df = frame(spark, 1)
    row = T.ranking_diagnostics(df, score_cols=["a"], treatment_col="t", outcome_col="y").first()
    assert (row.top_rows, row.bottom_rows) == (1.0, 1.0)


def test_policy_curve(spark):
    pdf, df = frame(spark)
    rows = T.policy_curve(df, score_cols=["a", "b"], treatment_col="t", outcome_col="y", fractions=FRACTIONS).collect()
    assert len(rows) == 10
    for row in rows:
        part = top(pdf, row.score_col, max(1, int(len(pdf) * row.top_fraction)))
        treated, control = part[part.t == 1].y, part[part.t == 0].y
        assert row["rows"] == len(part)
        assert row.mean_score == pytest.approx(part[row.score_col].mean())
        assert row.outcome_rate_lift == pytest.approx(part.y.mean() / pdf.y.mean())
        assert row.treated_outcome_rate == (pytest.approx(treated.mean()) if len(treated) else None)
        if len(treated) and len(control):
            assert row.observed_treated_control_gap == pytest.approx(treated.mean() - control.mean())
        else:
            assert row.observed_treated_control_gap is None


def test_known_effect_report(spark):
    pdf, df = frame(spark)
    pdf["c"] = pdf["a"] + pdf["e"]
    df = df.withColumn("c", F.col("a") + F.col("e"))
    rows = T.known_effect_report(df, score_cols=["a", "c"], true_effect_col="e", fractions=(0.1, 0.3)).collect()
    assert {r.score_col for r in rows} == {"a", "c", "oracle_true_effect"}
    for row in rows:
        column = "e" if row.score_col == "oracle_true_effect" else row.score_col
        part = top(pdf, column, int(len(pdf) * row.top_fraction))
        assert row.mean_true_effect == pytest.approx(part.e.mean())
        assert row.true_effect_lift == pytest.approx(part.e.mean() / pdf.e.mean())
        if column != "e":
            assert row.spearman_corr_with_true_effect == pytest.approx(pdf[column].rank().corr(pdf.e.rank()))
            assert row.pearson_corr_with_true_effect == pytest.approx(pdf[column].corr(pdf.e))
        else:
            assert (row.spearman_corr_with_true_effect, row.mean_score) == (1.0, None)


def policies(df, **options):
    return T.policy_table(
        df, score_cols=["a", "b"], fractions=(0.1, 0.3), outcome_col="y", treatment_col="t", **options
    )


def test_policy_table(spark):
    pdf, df = frame(spark)
    rows = {(r.policy_name, r.top_fraction): r for r in policies(df, true_effect_col="e", seed=5).collect()}
    assert len(rows) == 1 + 2 * 4
    drawn = {r.timestamp for r in random_selection(df, [0.3], seed=5).collect()}
    for (name, fraction), row in rows.items():
        k = int(len(pdf) * fraction)
        column = {"oracle_true_effect": "e", "top_a": "a", "top_b": "b"}.get(name)
        part = pdf if name == "all_rows" else top(pdf, column, k) if column else None
        if part is None and fraction == 0.3:
            part = pdf[pdf.timestamp.isin(drawn)]
        assert (row.selected_rows, row.score_col) == (k, column)
        if part is None:
            continue
        assert row.expected_incremental_conversions == pytest.approx(part.e.sum())
        assert row.observed_outcome_lift == pytest.approx(part.y.mean() / pdf.y.mean())
        assert row.mean_score == (pytest.approx(part[column].mean()) if column else None)
        if name == "all_rows":
            assert row.oracle_regret_incremental_conversions is None
        else:
            best = top(pdf, "e", k).e.sum()
            assert row.oracle_regret_incremental_conversions == pytest.approx(best - part.e.sum())


def test_regret_of_all_rows_exists_when_everything_is_a_budget(spark):
    _, df = frame(spark)
    table = T.policy_table(
        df, score_cols=["a"], fractions=(0.5, 1.0), outcome_col="y", treatment_col="t", true_effect_col="e"
    )
    row = table.filter("policy_name = 'all_rows'").first()
    assert row.oracle_regret_incremental_conversions == pytest.approx(0.0)


def test_decision_without_known_effect(spark):
    _, df = frame(spark)
    table = policies(df)
    assert "mean_true_effect" not in table.columns and table.filter("policy_name = 'oracle_true_effect'").isEmpty()
    comparison = T.policy_comparison(table, preferred_score_col="a")
    assert [r.oracle_capture_rate for r in comparison.collect()] == [None, None]
    row = T.policy_recommendation(comparison, recommended_top_fraction=0.25).first()
    assert row.recommended_top_fraction == 0.3 and row.recommended_oracle_capture_rate is None
    halves = comparison.withColumn("top_fraction", F.when(F.col("top_fraction") == 0.1, 0.25).otherwise(0.75))
    # both budgets are equally near to the request: the smaller one wins
    assert T.policy_recommendation(halves, recommended_top_fraction=0.5).first().recommended_top_fraction == 0.25


def test_decision_report(spark):
    pdf, df = frame(spark)
    comparison = T.policy_comparison(policies(df, true_effect_col="e"), preferred_score_col="b")
    rows = comparison.collect()
    assert [r.top_fraction for r in rows] == [0.1, 0.3]
    for row in rows:
        k = int(len(pdf) * row.top_fraction)
        own, best = top(pdf, "b", k).e.sum(), top(pdf, "e", k).e.sum()
        assert row.oracle_capture_rate == pytest.approx(own / best)
        assert row.incremental_conversions_vs_random == pytest.approx(own - row.random_expected_incremental_conversions)
    pick = T.policy_recommendation(comparison).first()
    assert pick.recommended_top_fraction == 0.1
    assert pick.highest_oracle_capture_rate == pytest.approx(max(r.oracle_capture_rate for r in rows))
    with pytest.raises(ValueError, match="preferred policy is missing"):
        T.policy_comparison(policies(df), preferred_score_col="zzz")


def test_input_errors(spark):
    _, df = frame(spark, 5)
    options = {"outcome_col": "y", "treatment_col": "t"}
    with pytest.raises(ValueError, match="at least one row"):
        T.policy_table(df.limit(0), score_cols=["a"], fractions=[0.1], **options)
    with pytest.raises(ValueError, match=r"missing from input: \['zz'\]"):
        T.policy_table(df, score_cols=["zz"], fractions=[0.1], **options)
    with pytest.raises(ValueError, match="top_fractions"):
        T.policy_table(df, score_cols=["a"], fractions=[1.5], **options)


def test_correlation_skips_gaps_and_is_null_for_a_constant(spark):
    pdf, df = frame(spark)
    assert T.score_correlation(df, "a", "b").first()[0] == pytest.approx(pdf.a.corr(pdf.b))
    constant = df.withColumn("c", F.lit(2.0))
    assert T.score_correlation(constant, "a", "c").first()[0] is None
    report = T.known_effect_report(constant, score_cols=["c"], true_effect_col="e", fractions=(0.1,))
    row = report.filter("score_col = 'c'").first()
    assert row.spearman_corr_with_true_effect is None and row.pearson_corr_with_true_effect is None
    assert row.mean_true_effect == pytest.approx(pdf.head(70).e.mean())
