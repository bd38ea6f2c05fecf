import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adtally.operators import models
from adtally.operators.models import Features
from adtally.plans import jobs
from adtally.sources import staging


def test_attribution_run_writes_reports_and_a_run_row(spark, log, tmp_path):
    jobs.run_attribution(log, folder=str(tmp_path), run_name="weekly", dataset="log", top_campaigns=3)
    run = spark.read.parquet(f"{tmp_path}/runs").first()
    assert run.run_id.endswith("_weekly") and run.metrics["campaigns"] == 10.0 and run.schema_version == 1
    report = spark.read.parquet(f"{tmp_path}/campaign_decision_report")
    assert report.count() == 10 and report.first().run_id == run.run_id
    jobs.run_attribution(log, folder=str(tmp_path), run_name="weekly", dataset="log")
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 2


SMALL = Features(numeric=("log_cost", "has_prev_click", "campaign_ctr"), categorical=("cat1", "recency_bucket"))


def test_click_run(spark, log, tmp_path):
    job = jobs.ClickJob(features=SMALL, top_campaigns=3, time_slices=3)
    reports = jobs.run_click_model(log, job, folder=str(tmp_path), run_name="ctr")
    assert {r.split for r in reports["click_metrics"].collect()} == {"validation", "test"}
    assert reports["click_campaign_slices"].count() == 3 and reports["click_time_slices"].count() == 3
    run = spark.read.parquet(f"{tmp_path}/runs").first()
    assert run.pipeline_name == "click_model" and run.train_rows + run.validation_rows + run.test_rows == log.count()
    assert (tmp_path / "models" / "ctr" / "click_model").exists()


def test_click_comparison(spark, log):
    rows = jobs.compare_click_models(
        log,
        {
            "logistic": jobs.ClickJob(features=SMALL, validation_fraction=0.0),
            "trees": jobs.ClickJob(
                features=SMALL, validation_fraction=0.0, model_type="boosted_trees",
                model_params={"n_estimators": 2, "max_depth": 2},
            ),
        },
    ).collect()
    for name in ("rank_roc_auc", "rank_pr_auc", "rank_log_loss", "rank_brier_score"):
        assert sorted(r[name] for r in rows) == [1, 2]
    best = min(rows, key=lambda r: r.rank_roc_auc)
    assert best.roc_auc == max(r.roc_auc for r in rows)


def test_calibration_drift_run(spark, log):
    reports = jobs.run_calibration_drift(log, jobs.ClickJob(features=SMALL), bins=5)
    row = reports["calibration_drift"].first()
    assert row.bins == 5 and reports["calibration_drift_bins"].count() == 5
    with pytest.raises(ValueError, match="no validation rows"):
        jobs.run_calibration_drift(log, jobs.ClickJob(features=SMALL, validation_fraction=0.0))


def test_unknown_encoding_is_refused(log):
    with pytest.raises(ValueError, match="Unsupported train_only_encoding: other"):
        jobs.prepare_click_table(log, jobs.ClickJob(train_only_encodings=("other",)))


@pytest.fixture(scope="module")
def uplift(log):
    job = jobs.UpliftJob(
        jobs.UpliftSpec(
            treatment_col="synthetic_treatment", outcome_col="synthetic_outcome",
            features=Features(numeric=("cost_rank", "cpo_rank", "recency_rank", "has_prev_click"), categorical=("cat1",)),
        )
    )
    models, table = jobs.score_uplift_table(log, job)
    return job, models, table


def test_uplift_targeting_scoring_and_drift_share_one_scored_table(spark, uplift, tmp_path):
    job, models, table = uplift
    assert set(models) == {"propensity_model", "treated_outcome_model", "control_outcome_model", "tau_model"}
    reports = jobs.uplift_evaluation(table, job)
    assert reports["uplift_summary"].count() == 2 and reports["uplift_ranking"].count() == 4
    assert reports["uplift_policy_curve"].count() == 2 * 2 * 5
    targeting = jobs.run_targeting(table, job, folder=str(tmp_path))
    assert targeting["policy_table"].count() == 1 + 5 * 4
    batch = jobs.run_batch_scoring(table, job, folder=str(tmp_path))
    tests = table.filter("split = 'test'").count()
    assert batch["batch_scores"].count() == tests
    assert batch["batch_summary"].first().recommended_rows == max(1, int(tests * 0.1))
    drift = jobs.run_drift(table, numeric=["cost_rank", "log_cpo"], categorical=["campaign"], folder=str(tmp_path))
    summary = drift["drift_summary"].first()
    assert (summary.numeric_feature_count, summary.categorical_feature_count, summary.score_count) == (2, 1, 2)
    assert summary.max_score_psi == drift["score_drift"].agg(F.max("psi")).first()[0]
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 3


def test_observational_uplift_with_trees(spark, log, tmp_path):
    """Clicks as treatment and conversions as outcome, without a known effect."""
    job = jobs.UpliftJob(
        jobs.UpliftSpec(
            treatment_col="click", outcome_col="conversion", learner="boosted_trees",
            features=Features(numeric=("log_cost", "has_prev_click"), categorical=("cat1",)),
            learner_params={"n_estimators": 2, "max_depth": 2},
        ),
        feature_set="ctr_notebook_v1", known_effect=False,
    )
    reports = jobs.run_uplift(log, job, folder=str(tmp_path), run_name="observed")
    assert set(reports) == {"uplift_summary", "uplift_ranking", "uplift_policy_curve"}
    assert {r.split for r in reports["uplift_summary"].collect()} == {"validation", "test"}
    assert sorted(p.name for p in (tmp_path / "models" / "observed").iterdir()) == [
        "control_outcome_model", "propensity_model", "tau_model", "treated_outcome_model",
    ]


def test_linear_model_recovers_the_known_effect(spark):
    """On 40,000 rows the ranks that define the effect let the linear learner order rows by it."""
    from adtally.operators.targeting import known_effect_report
    from adtally.sources.event_log import ad_log_table

    job = jobs.UpliftJob(
        jobs.UpliftSpec(
            treatment_col="synthetic_treatment", outcome_col="synthetic_outcome",
            features=Features(numeric=("cost_rank", "cpo_rank", "recency_rank", "has_prev_click"), categorical=()),
        )
    )
    _, table = jobs.score_uplift_table(ad_log_table(spark, "/root/testdata/sf0.1"), job)
    rows = known_effect_report(
        table.filter("split = 'test'"), score_cols=job.score_cols, true_effect_col=job.true_effect_col, fractions=(0.1,)
    ).collect()
    found = {row.score_col: row for row in rows}
    assert found["doubly_robust_score"].spearman_corr_with_true_effect > 0.8
    assert 1.2 < found["doubly_robust_score"].true_effect_lift < found["oracle_true_effect"].true_effect_lift


def test_a_run_with_a_folder_leaves_no_intermediate_tables(spark, log, tmp_path):
    with staging.staging_scope(spark):
        folder = staging.shared_folder(spark).removeprefix("file:")
        before = set(os.listdir(folder))
        reports = jobs.run_click_model(log, jobs.ClickJob(features=SMALL), folder=str(tmp_path), run_name="ctr")
        assert set(os.listdir(folder)) == before
    assert reports["click_metrics"].count() == 2
    run = spark.read.parquet(f"{tmp_path}/runs").first()
    assert run.metadata["label"] == "click" and "validation_roc_auc" in run.metrics


def test_dropping_staged_tables_empties_the_caches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "own"))
    monkeypatch.setattr(staging, "_caches", [])
    cache = staging.staged_cache()
    cache["t"] = staging.stage(spark.range(3).toDF("id"))
    assert cache["t"].count() == 3
    staging.drop_staged(spark)
    assert cache == {} and not (tmp_path / "own").exists()


def test_the_chosen_time_column_orders_the_split(spark, log):
    turned = log.withColumn("late_first", -F.col("timestamp"))
    job = jobs.ClickJob(features=SMALL, timestamp_col="late_first")
    ranges = jobs.prepare_click_table(turned, job).groupBy("split").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("z"))
    found = {r["split"]: (r["a"], r["z"]) for r in ranges.collect()}
    assert found["train"][0] >= found["validation"][1] >= found["test"][1]


def test_candidates_with_other_labels_do_not_share_a_table(spark, log):
    flipped = log.withColumn("not_click", 1 - F.col("click"))
    job = jobs.ClickJob(features=SMALL)
    rows = jobs.compare_click_models(flipped, {"a": job, "b": replace(job, label="not_click")}).collect()
    rates = {r["name"]: r["positive_rate"] for r in rows}
    assert abs(rates["a"] + rates["b"] - 1) < 1e-9
    assert {"validation_roc_auc", "model_params", "is_best"} <= set(rows[0].asDict())


def test_training_columns_without_values_are_refused(spark, log):
    empty = log.withColumn("has_prev_click", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="without any value.*has_prev_click"):
        models.fit_logistic(empty, Features(numeric=("has_prev_click",), categorical=()), "click")
    empty = log.withColumn("campaign", F.lit(None).cast("long"))
    with pytest.raises(ValueError, match="without any value.*campaign"):
        models.fit_logistic(empty, Features(numeric=(), categorical=("campaign",)), "click")


def test_no_number_of_categories_is_refused(spark, log):
    """Every row a category of its own: fitted by the iterative solver, scored by the joined codes."""
    wide = log.withColumn("own", F.col("timestamp") + F.col("uid"))
    model = models.fit_logistic(wide, Features(numeric=("cost",), categorical=("own",)), "click", max_iter=5)
    assert models.with_prediction(model, wide, "p").filter("p > 0 and p < 1").count() == wide.count() > 300
