"""The runs a user starts: attribution, click model, model comparison, uplift, targeting, scoring, drift.

Each takes a log table and an output folder, appends its reports there under a run id, and returns them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce, wraps
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.expressions import correlation
from adtally.operators import attribution, calibration, drift, evaluation, targeting
from adtally.operators.benchmark import add_known_effect_columns
from adtally.operators.contracts import check_source, check_training_table
from adtally.operators.encoding import encode_campaign, encoding_metadata
from adtally.operators.features import apply_feature_set
from adtally.operators.models import (
    Features, UpliftSpec, fit_click_model, fit_uplift, save_models, with_prediction, with_uplift_scores,
)
from adtally.operators.splits import split_order, time_split
from adtally.plans.runs import append_report, append_run, metrics_of, new_run_id, read_report
from adtally.sources.staging import stage, staging_scope
from adtally.sources.tables import head_rows

# Default features of the click model and of the benchmark uplift models.
CATEGORIES = tuple(f"cat{i}" for i in range(1, 10))
CLICK_FEATURES = Features(
    numeric=(
        "log_cost", "log_cpo", "time_since_last_click", "has_prev_click", "log_time_since_last_click", "campaign_ctr",
    ),
    categorical=(*CATEGORIES, "campaign", "recency_bucket"),
)
UPLIFT_FEATURES = Features(
    numeric=(
        "log_cost", "log_cpo", "time_since_last_click", "has_prev_click", "log_time_since_last_click",
        "cost_rank", "cpo_rank", "recency_rank",
    ),
    categorical=(*CATEGORIES, "campaign", "recency_bucket"),
)


def _finish(
    reports: Mapping[str, DataFrame], folder: str | None, run_name: str, pipeline: str, dataset: str, **run: Any
) -> dict[str, DataFrame]:
    """With an output folder: append the reports and the run row, and return the stored reports."""
    if folder is None:
        return dict(reports)
    run_id = new_run_id(run_name)
    spark = next(iter(reports.values())).sparkSession
    for name, report in reports.items():
        append_report(report, folder, name, run_id)
    append_run(spark, folder, run_id=run_id, run_name=run_name, pipeline_name=pipeline, dataset=dataset, **run)
    return {name: read_report(spark, folder, name, run_id) for name in reports}


def _released(run):
    """A run with an output folder deletes its intermediate tables; without one they live on with its reports."""

    @wraps(run)
    def scoped(*args: Any, **options: Any):
        if options.get("folder") is None:
            return run(*args, **options)
        given = args[0] if args else next(iter(options.values()))
        with staging_scope(given.sparkSession):
            return run(*args, **options)

    return scoped


def _described(**parts: Any) -> dict[str, str]:
    """Run metadata as text: label, features, model and parameters."""
    return {name: value if isinstance(value, str) else json.dumps(value, default=str) for name, value in parts.items()}


def _first_rows(log: DataFrame, max_rows: int | None) -> DataFrame:
    """The whole log, or its first rows where a run is limited on purpose."""
    return log if max_rows is None else stage(head_rows(log, max_rows), "head")


def _split_rows(df: DataFrame) -> dict[str, int]:
    counts = {row["split"]: row["count"] for row in df.groupBy("split").count().collect()}
    return {f"{name}_rows": counts.get(name, 0) for name in ("train", "validation", "test")}


def _part(df: DataFrame, split: str) -> DataFrame:
    return df.filter(F.col("split") == split)


@_released
def run_attribution(
    log: DataFrame,
    *,
    folder: str | None = None,
    run_name: str = "attribution",
    dataset: str = "",
    decay_rate: float = 0.5,
    top_campaigns: int = 20,
    max_rows: int | None = None,
) -> dict[str, DataFrame]:
    log = _first_rows(log, max_rows)
    # One row per campaign; reread by all reports below, so it is written once.
    report = stage(attribution.campaign_report(log, decay_rate=decay_rate), "campaigns")
    decisions = attribution.decision_report(report)
    summary = attribution.attribution_summary(log, report, decay_rate=decay_rate)
    reports = {
        "attribution_summary": summary,
        "campaign_summary": attribution.campaign_summary(report),
        "campaign_decision_report": decisions,
        "campaign_top_lists": attribution.top_lists(report, top_campaigns=top_campaigns),
        "campaign_review_views": attribution.review_views(decisions, top_campaigns=top_campaigns),
    }
    metrics = metrics_of(summary) if folder else {}
    return _finish(
        reports, folder, run_name, "attribution", dataset, metrics=metrics, test_rows=int(metrics.get("rows", 0))
    )


@dataclass(frozen=True)
class ClickJob:
    label: str = "click"
    timestamp_col: str = "timestamp"
    feature_set: str | None = "ctr_notebook_v2"
    features: Features = CLICK_FEATURES
    train_only_encodings: Sequence[str] = ("campaign_ctr",)
    train_fraction: float = 0.7
    validation_fraction: float = 0.1
    model_type: str = "logistic_regression"
    model_params: Mapping[str, Any] = field(default_factory=dict)
    top_campaigns: int = 10
    time_slices: int = 5


def prepare_click_table(log: DataFrame, job: ClickJob, *, checked: bool = False) -> DataFrame:
    """Checked, featurised, split and encoded rows, written once for fits and metrics."""
    if not checked:
        check_source(log)
    unknown = [name for name in job.train_only_encodings if name != "campaign_ctr"]
    if unknown:
        raise ValueError(f"Unsupported train_only_encoding: {unknown[0]}")
    columns = {
        "label_col": job.label,
        "timestamp_col": job.timestamp_col,
        "categorical_features": list(job.features.categorical),
    }
    table = apply_feature_set(log, job.feature_set)
    before = [name for name in job.features.numeric if name not in job.train_only_encodings]
    check_training_table(table, numeric_features=before, **columns)
    order = split_order(job.timestamp_col)
    table = time_split(
        table, train_fraction=job.train_fraction, validation_fraction=job.validation_fraction, order=order
    )
    if job.train_only_encodings:
        table = encode_campaign(table, label_col=job.label)
    table = stage(table, "click-table", partition_by=["split"])
    check_training_table(table, split_col="split", numeric_features=list(job.features.numeric), **columns)
    return table


def score_click_table(table: DataFrame, job: ClickJob):
    """(fitted model, validation and test rows with `pred_score`)."""
    model = fit_click_model(
        _part(table, "train"), job.features, job.label, model_type=job.model_type, params=job.model_params
    )
    scored = with_prediction(model, table.filter("split <> 'train'"), "pred_score")
    return model, stage(scored, "click-scores", partition_by=["split"])


@_released
def run_click_model(
    log: DataFrame,
    job: ClickJob = ClickJob(),
    *,
    folder: str | None = None,
    run_name: str = "ctr_baseline",
    dataset: str = "",
    table: DataFrame | None = None,
    max_rows: int | None = None,
    wanted: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Fit, score and report; without a folder only the `wanted` reports are built (all if None)."""
    table = prepare_click_table(_first_rows(log, max_rows), job) if table is None else table
    model, scored = score_click_table(table, job)
    test = _part(scored, "test")
    names = {"label_col": job.label, "score_col": "pred_score"}
    order = split_order(job.timestamp_col)
    cache: dict[str, DataFrame] = {}

    def bins() -> DataFrame:
        if "bins" not in cache:
            cache["bins"] = stage(evaluation.calibration_bins(test, **names), "bins")
        return cache["bins"]

    # Building a report already runs jobs, so only what is wanted is built.
    makers = {
        "click_metrics": lambda: stage(evaluation.binary_metrics(scored, by=["split"], **names), "metrics"),
        "click_calibration_bins": bins,
        "click_calibration_summary": lambda: evaluation.calibration_summary(bins()),
        "click_campaign_slices": lambda: evaluation.campaign_slices(test, top_campaigns=job.top_campaigns, **names),
        "click_time_slices": lambda: evaluation.time_slices(
            test, slices=job.time_slices, timestamp_col=job.timestamp_col, order=order, **names
        ),
    }
    if job.train_only_encodings:
        makers["click_encoding"] = lambda: encoding_metadata(table, label_col=job.label)
    reports = {name: make() for name, make in makers.items() if wanted is None or folder is not None or name in wanted}
    if folder is None:
        return reports
    save_models({"click_model": model}, f"{folder}/models/{run_name}")
    metrics = metrics_of(_part(reports["click_metrics"], "test"))
    metrics |= {f"validation_{k}": v for k, v in metrics_of(_part(reports["click_metrics"], "validation")).items()}
    return _finish(
        reports, folder, run_name, "click_model", dataset, metrics=metrics, metadata=_click_metadata(job),
        **_split_rows(table),
    )


def _click_metadata(job: ClickJob) -> dict[str, str]:
    return _described(
        label=job.label, timestamp_col=job.timestamp_col, feature_set=job.feature_set or "",
        numeric_features=list(job.features.numeric), categorical_features=list(job.features.categorical),
        train_only_encodings=list(job.train_only_encodings), model_type=job.model_type, model_params=dict(job.model_params),
    )


@_released
def compare_click_models(
    log: DataFrame, candidates: Mapping[str, ClickJob], *, folder: str | None = None, run_name: str = "ctr_compare",
    dataset: str = "",
) -> DataFrame:
    """Test metrics of every candidate with four rankings; rank 1 by `rank_roc_auc` is the best model.

    Candidates that share features and split share one prepared table.
    """
    tables: dict[tuple, DataFrame] = {}
    rows = []
    for name, job in candidates.items():
        key = (
            job.label, job.timestamp_col, job.feature_set, tuple(job.features.numeric), tuple(job.features.categorical),
            tuple(job.train_only_encodings), job.train_fraction, job.validation_fraction,
        )
        if key not in tables:
            tables[key] = prepare_click_table(log, job, checked=bool(tables))
        reports = run_click_model(log, job, table=tables[key], wanted=("click_metrics", "click_calibration_summary"))
        metrics = _part(reports["click_metrics"], "test").drop("split")
        held = _part(reports["click_metrics"], "validation").drop("split")
        held = held.select(*[F.col(c).alias(f"validation_{c}") for c in held.columns], F.lit(1).alias("one"))
        summary = reports["click_calibration_summary"].withColumn("one", F.lit(1))
        # One row on both sides.
        rows.append(
            metrics.withColumn("one", F.lit(1))
            .join(F.broadcast(summary), "one")
            .join(F.broadcast(held), "one", "left")
            .drop("one")
            .select(
                F.lit(name).alias("name"), F.lit(job.model_type).alias("model_type"),
                F.lit(json.dumps(dict(job.model_params))).alias("model_params"), "*",
            )
        )
    metrics = stage(reduce(DataFrame.unionByName, rows), "comparison")
    everything = Window.partitionBy(F.lit(0))
    best = {
        "rank_roc_auc": F.desc_nulls_last("roc_auc"),
        "rank_pr_auc": F.desc_nulls_last("pr_auc"),
        "rank_log_loss": F.asc("log_loss"),
        "rank_brier_score": F.asc("brier_score"),
    }
    # One row per candidate.
    ranked = metrics.withColumns(
        {name: F.row_number().over(everything.orderBy(order, "name")) for name, order in best.items()}
    ).withColumn("is_best", F.col("rank_roc_auc") == 1)
    if folder is None:
        return ranked
    winner = metrics_of(ranked.filter("is_best"))
    metadata = {name: json.dumps(_click_metadata(job)) for name, job in candidates.items()}
    metadata["best_model"] = ranked.filter("is_best").first()["name"]
    stored = _finish(
        {"click_comparison": ranked}, folder, run_name, "click_comparison", dataset, metrics=winner, metadata=metadata,
        **_split_rows(next(iter(tables.values()))),
    )
    return stored["click_comparison"]


@dataclass(frozen=True)
class UpliftJob:
    spec: UpliftSpec
    feature_set: str | None = "semisynthetic_rank_v1"
    train_fraction: float = 0.7
    validation_fraction: float = 0.1
    known_effect: bool = True
    seed: int = 42
    score_cols: Sequence[str] = ("observational_score", "doubly_robust_score")
    true_effect_col: str = "true_treatment_effect"


def benchmark_job(**spec: Any) -> UpliftJob:
    """Uplift on benchmark columns with a known effect."""
    return UpliftJob(
        UpliftSpec(
            treatment_col="synthetic_treatment", outcome_col="synthetic_outcome", features=UPLIFT_FEATURES, **spec
        )
    )


def prepare_uplift_table(log: DataFrame, job: UpliftJob) -> DataFrame:
    check_source(log)
    table = apply_feature_set(log, job.feature_set)
    if job.known_effect:
        # Ranking scans its input several times, so the features are written first; so is the result below.
        table = add_known_effect_columns(
            stage(table, "features"),
            treatment_col=job.spec.treatment_col,
            outcome_col=job.spec.outcome_col,
            true_effect_col=job.true_effect_col,
            seed=job.seed,
        )
    table = stage(table, "uplift-features")
    return time_split(table, train_fraction=job.train_fraction, validation_fraction=job.validation_fraction)


def score_uplift_table(log: DataFrame, job: UpliftJob, *, max_rows: int | None = None):
    """(four fitted models, all rows with split and five scores). Fitted once, read by every report below.

    With `max_rows` targeting, scoring and drift rest on the first rows of the log only.
    """
    table = prepare_uplift_table(_first_rows(log, max_rows), job)
    models = fit_uplift(_part(table, "train"), job.spec)
    return models, stage(with_uplift_scores(table, models, job.spec), "uplift-scores", partition_by=["split"])


def _by_split(scored: DataFrame, splits: Sequence[str], report) -> DataFrame:
    parts = [report(_part(scored, name)).withColumn("split", F.lit(name)) for name in splits]
    return reduce(DataFrame.unionByName, parts)


def uplift_evaluation(scored: DataFrame, job: UpliftJob, splits: Sequence[str] = ("validation", "test")):
    """Per split: volumes, propensity quality, score correlation, ranking diagnostics and policy curves."""
    spec = job.spec
    names = {"treatment_col": spec.treatment_col, "outcome_col": spec.outcome_col}
    pair = ("observational_score", "doubly_robust_score")
    chosen = scored.filter(F.col("split").isin(*splits))
    totals = chosen.groupBy("split").agg(
        F.avg(spec.treatment_col).alias("treatment_rate"),
        F.avg(spec.outcome_col).alias("outcome_rate"),
        correlation(*pair).alias("score_correlation"),
    )
    propensity = evaluation.binary_metrics(
        chosen, label_col=spec.treatment_col, score_col="propensity_score", by=["split"]
    )
    return {
        # One row per split on both sides.
        "uplift_summary": propensity.join(F.broadcast(totals), "split"),
        "uplift_ranking": _by_split(
            scored, splits, lambda part: targeting.ranking_diagnostics(part, score_cols=pair, **names)
        ),
        "uplift_policy_curve": _by_split(
            scored, splits, lambda part: targeting.policy_curve(part, score_cols=pair, **names)
        ),
    }


@_released
def run_uplift(
    log: DataFrame, job: UpliftJob, *, folder: str | None = None, run_name: str = "uplift", dataset: str = "",
    max_rows: int | None = None,
) -> dict[str, DataFrame]:
    models, scored = score_uplift_table(log, job, max_rows=max_rows)
    reports = uplift_evaluation(scored, job)
    if job.known_effect:
        reports["uplift_known_effect"] = targeting.known_effect_report(
            _part(scored, "test"), score_cols=job.score_cols, true_effect_col=job.true_effect_col
        )
    if folder is None:
        return reports
    save_models(models, f"{folder}/models/{run_name}")
    metrics = metrics_of(_part(reports["uplift_summary"], "test"))
    metrics |= {f"validation_{k}": v for k, v in metrics_of(_part(reports["uplift_summary"], "validation")).items()}
    spec = job.spec
    metadata = _described(
        treatment_col=spec.treatment_col, outcome_col=spec.outcome_col, numeric_features=list(spec.features.numeric),
        categorical_features=list(spec.features.categorical), learner=spec.learner, learner_params=dict(spec.learner_params),
    )
    return _finish(
        reports, folder, run_name, "uplift", dataset, metrics=metrics, metadata=metadata, **_split_rows(scored)
    )


@_released
def run_targeting(
    scored: DataFrame,
    job: UpliftJob,
    *,
    fractions: Sequence[float] = targeting.FRACTIONS,
    preferred_score_col: str = "doubly_robust_score",
    recommended_top_fraction: float | None = None,
    seed: int = 42,
    folder: str | None = None,
    run_name: str = "policy_simulation",
    dataset: str = "",
) -> dict[str, DataFrame]:
    """Policies at every budget on the test rows of a scored table, the comparison and the recommendation."""
    policies = stage(
        targeting.policy_table(
            _part(scored, "test"),
            score_cols=job.score_cols,
            fractions=fractions,
            outcome_col=job.spec.outcome_col,
            treatment_col=job.spec.treatment_col,
            true_effect_col=job.true_effect_col if job.known_effect else None,
            seed=seed,
        ),
        "policies",
    )
    comparison = targeting.policy_comparison(policies, preferred_score_col=preferred_score_col)
    reports = {
        "policy_table": policies,
        "policy_comparison": comparison,
        "policy_recommendation": targeting.policy_recommendation(
            comparison, recommended_top_fraction=recommended_top_fraction
        ),
    }
    if folder is None:
        return reports
    metrics = metrics_of(reports["policy_recommendation"])
    return _finish(reports, folder, run_name, "policy_simulation", dataset, metrics=metrics, **_split_rows(scored))


@_released
def run_batch_scoring(
    scored: DataFrame,
    job: UpliftJob,
    *,
    preferred_score_col: str = "doubly_robust_score",
    recommended_top_fraction: float = 0.1,
    id_columns: Sequence[str] = ("uid", "timestamp", "campaign"),
    optional_columns: Sequence[str] = (),
    folder: str | None = None,
    run_name: str = "batch_scoring",
    dataset: str = "",
) -> dict[str, DataFrame]:
    """Row-level scores, ranks and targeting flags of the test rows of a scored table."""
    extra = [*optional_columns, job.true_effect_col] if job.known_effect else list(optional_columns)
    rows = targeting.batch_scores(
        _part(scored, "test"),
        id_columns=id_columns,
        score_cols=job.score_cols,
        preferred_score_col=preferred_score_col,
        recommended_top_fraction=recommended_top_fraction,
        optional_columns=extra,
    )
    summary = targeting.batch_summary(
        rows, preferred_score_col=preferred_score_col, true_effect_col=job.true_effect_col if job.known_effect else None
    )
    reports = {"batch_scores": rows, "batch_summary": summary}
    if folder is None:
        return reports
    return _finish(
        reports, folder, run_name, "batch_scoring", dataset, metrics=metrics_of(summary), **_split_rows(scored)
    )


@_released
def run_drift(
    scored: DataFrame,
    *,
    numeric: Sequence[str],
    categorical: Sequence[str],
    scores: Sequence[str] = ("observational_score", "doubly_robust_score"),
    bins: int = 10,
    top_n: int = 20,
    folder: str | None = None,
    run_name: str = "drift_report",
    dataset: str = "",
) -> dict[str, DataFrame]:
    """Feature and score drift of the test rows against the training rows of a scored table."""
    reference, current = _part(scored, "train"), _part(scored, "test")
    # Features and scores share the passes over both tables.
    both = stage(drift.numeric_drift(reference, current, columns=[*numeric, *scores], bins=bins), "drift")
    numeric_rows = both.filter(F.col("column").isin(*numeric))
    score_rows = both.filter(F.col("column").isin(*scores))
    categorical_rows = stage(drift.categorical_drift(reference, current, columns=categorical, top_n=top_n), "drift")
    reports = {
        "numeric_drift": numeric_rows,
        "categorical_drift": categorical_rows,
        "score_drift": score_rows,
        # Validation rows are neither reference nor current; their number says what the report leaves out.
        "drift_summary": drift.drift_summary(numeric_rows, categorical_rows, score_rows).withColumn(
            "validation_rows", F.lit(_part(scored, "validation").count())
        ),
    }
    if folder is None:
        return reports
    metrics = metrics_of(reports["drift_summary"])
    return _finish(reports, folder, run_name, "drift_report", dataset, metrics=metrics, **_split_rows(scored))


@_released
def run_calibration_drift(
    log: DataFrame,
    job: ClickJob = ClickJob(),
    *,
    bins: int = 10,
    folder: str | None = None,
    run_name: str = "calibration_drift",
    dataset: str = "",
) -> dict[str, DataFrame]:
    """Calibration of the test rows against the validation rows of a click model."""
    table = prepare_click_table(log, job)
    if _part(table, "validation").isEmpty():
        raise ValueError("there are no validation rows to compare the test rows with")
    _, scored = score_click_table(table, job)
    totals = stage(
        calibration.calibration_totals(
            _part(scored, "validation"), _part(scored, "test"), label_col=job.label, score_col="pred_score", bins=bins
        ),
        "calibration",
    )
    reports = {
        "calibration_drift": calibration.calibration_drift_summary(totals),
        "calibration_drift_bins": calibration.calibration_drift_bins(totals),
    }
    if folder is None:
        return reports
    metrics = metrics_of(reports["calibration_drift"])
    return _finish(reports, folder, run_name, "calibration_drift", dataset, metrics=metrics, **_split_rows(table))
