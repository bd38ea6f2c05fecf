"""Named queries over the stored tables, one per operator. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.functions.binning import with_right_closed_bin
from adtally.functions.expressions import clip, hash_uniform
from adtally.operators import artifacts, attribution, calibration, contracts, drift, encoding, evaluation, features
from adtally.operators import models, profile, splits, targeting, trees, verdicts
from adtally.operators.benchmark import add_known_effect_columns
from adtally.operators.ranking import with_average_ranks
from adtally.plans import jobs
from adtally.sources.event_log import ad_log, ad_log_table
from adtally.sources.staging import shared_folder, stage, staged_cache
from adtally.sources.tables import (
    head_rows, read_json, read_table, write_csv, write_json, write_parquet, write_tsv,
)

Query = Callable[[SparkSession, str], DataFrame]

KEY = ("timestamp", "uid", "campaign")
SCORES = ("observational_score", "doubly_robust_score")
EFFECT = "true_treatment_effect"
TREATMENT, OUTCOME = "synthetic_treatment", "synthetic_outcome"

_tables: dict[tuple[str, str, str], DataFrame] = staged_cache()


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as long, doubles rounded to six digits, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DoubleType):
            rounded = F.round(column, 6)
            column = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _once(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """A derived table written once per application: several reports read it, as they would a stored table."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _tables:
        _tables[key] = stage(build(), name, partition_by=partition_by)
    return _tables[key]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def split_log(spark: SparkSession, folder: str) -> DataFrame:
    """The ad log with click features and the 70/10/20 time split."""
    return _once(
        spark, folder, "split-log",
        lambda: splits.time_split(
            features.apply_feature_set(ad_log_table(spark, folder), "ctr_notebook_v2"),
            train_fraction=0.7, validation_fraction=0.1,
        ),
        ("split",),
    )


def click_score() -> Column:
    """A closed-form click score: the evaluation operators need a score that other engines can repeat."""
    return F.lit(0.05) + F.lit(0.9) * F.col("cost") / (F.col("cost") + F.lit(40.0) + F.col("cpo"))


def click_scored(spark: SparkSession, folder: str) -> DataFrame:
    return split_log(spark, folder).withColumn("pred_score", click_score())


def uplift_table(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark columns, time split and two closed-form uplift scores on the whole log."""

    def build() -> DataFrame:
        # Effects are drawn from the raw columns: logarithms may merge neighbouring doubles differently elsewhere.
        # Both rank steps and the split scan their input several times, so each step's result is written.
        known = stage(add_known_effect_columns(ad_log_table(spark, folder), seed=42), "known-effect")
        known = stage(features.apply_feature_set(known, "semisynthetic_rank_v1"), "known-features")
        return splits.time_split(known, train_fraction=0.7, validation_fraction=0.1).withColumns(
            {
                "propensity_score": clip(F.col("cost") / (F.col("cost") + F.lit(20.0)), 0.05, 0.95),
                "treated_outcome_score": F.lit(0.1) + F.col("cpo") / F.lit(50.0),
                "control_outcome_score": F.lit(0.05) + F.col("cost") / (F.col("cost") + F.lit(300.0)),
                "observational_score": F.col("cpo") / F.lit(50.0) - F.col("cost") / (F.col("cost") + F.lit(300.0)),
                "doubly_robust_score": F.lit(0.01) * F.col("cpo") + F.lit(0.03) * F.col("has_prev_click"),
            }
        )

    return _once(spark, folder, "uplift", build, ("split",))


def uplift_test(spark: SparkSession, folder: str) -> DataFrame:
    return uplift_table(spark, folder).filter("split = 'test'")


def _policies(spark: SparkSession, folder: str) -> DataFrame:
    return _once(
        spark, folder, "policy-table",
        lambda: targeting.policy_table(
            uplift_test(spark, folder), score_cols=SCORES, fractions=targeting.FRACTIONS,
            outcome_col=OUTCOME, treatment_col=TREATMENT, true_effect_col=EFFECT, seed=42,
        ),
    )


def _batch_scores(spark: SparkSession, folder: str) -> DataFrame:
    return targeting.batch_scores(
        uplift_test(spark, folder), id_columns=("uid", "timestamp", "campaign"), score_cols=SCORES,
        preferred_score_col="doubly_robust_score", recommended_top_fraction=0.1, optional_columns=(EFFECT,),
    )


NUMERIC_DRIFT = ("log_cost", "log_cpo", "time_since_last_click", "cost_rank", "recency_rank")
CATEGORICAL_DRIFT = ("campaign", "recency_bucket", "cat9")


def _drift_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    table = uplift_table(spark, folder)
    return table.filter("split = 'train'"), table.filter("split = 'test'")


def _numeric_drift(spark: SparkSession, folder: str, columns=(*NUMERIC_DRIFT, *SCORES)) -> DataFrame:
    return drift.numeric_drift(*_drift_sides(spark, folder), columns=columns, bins=10)


def _categorical_drift(spark: SparkSession, folder: str) -> DataFrame:
    return drift.categorical_drift(*_drift_sides(spark, folder), columns=CATEGORICAL_DRIFT, top_n=5)


def _drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    both = stage(_numeric_drift(spark, folder), "drift")
    is_score = F.col("column").isin(*SCORES)
    return drift.drift_summary(both.filter(~is_score), _categorical_drift(spark, folder), both.filter(is_score))


def _calibration_totals(spark: SparkSession, folder: str) -> DataFrame:
    scored = click_scored(spark, folder)
    totals = calibration.calibration_totals(
        scored.filter("split = 'validation'"), scored.filter("split = 'test'"),
        label_col="click", score_col="pred_score", bins=10,
    )
    return stage(totals, "calibration")


def _lineitem_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = _table(spark, folder, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    return lines.filter(early), lines.filter(~early)


def _lineitem_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    return contracts.quality_violations(
        lines, required=lines.columns, key=("l_orderkey", "l_linenumber"),
        minimums={"l_quantity": 10, "l_discount": 0.0}, binary=(),
    )


def _lineitem_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_numeric(
        _table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


def _pseudo_outcome_column() -> Column:
    return models.doubly_robust_outcome(
        treatment=F.col(TREATMENT), outcome=F.col(OUTCOME), propensity=F.col("propensity_score"),
        treated_score=F.col("treated_outcome_score"), control_score=F.col("control_outcome_score"),
    )


def _pseudo_outcome(spark: SparkSession, folder: str) -> DataFrame:
    return uplift_table(spark, folder).select(*KEY, _pseudo_outcome_column().alias("effect_outcome"))


def _click_time_slices(spark: SparkSession, folder: str) -> DataFrame:
    report = evaluation.time_slices(
        click_scored(spark, folder).filter("split = 'test'"), label_col="click", score_col="pred_score", slices=5
    )
    return report.withColumns(
        {name: F.col(name).cast("long") for name in ("timestamp_min", "timestamp_max")}
    )


def _missing_users(spark: SparkSession, folder: str) -> DataFrame:
    """The ad log of events of which every tenth has lost its user."""

    def build() -> DataFrame:
        user = F.when(F.col("event_id") % 10 != 0, F.col("user_id"))
        return ad_log(_table(spark, folder, "events").withColumn("user_id", user))

    return _once(spark, folder, "missing-users", build)


def _discount_with_nan(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("l_linenumber") != 3, F.col("l_discount").cast("double")).otherwise(F.lit(float("nan")))
    return _table(spark, folder, "lineitem").withColumn("l_discount", value)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _round_trip(write: Callable[[DataFrame, str], None], suffix: str) -> Query:
    """Orders written to the shared folder in a format and read back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        orders = _table(spark, folder, "orders").select(*ORDER_COLUMNS)
        path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}{suffix}"
        write(orders, path)
        if suffix == ".json":
            return read_json(spark, path, schema=orders.schema)
        return read_table(spark, path, schema=None if suffix == ".parquet" else orders.schema)

    return query


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """The run row of an attribution run, and its metrics as the run stored them."""
    target = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    jobs.run_attribution(ad_log_table(spark, folder), folder=target, run_name="weekly", dataset="events")
    runs = spark.read.parquet(f"{target}/runs")
    names = ("run_name", "pipeline_name", "dataset", "test_rows")
    return runs.select(*names, F.explode("metrics").alias("metric", "value")).filter("metric in ('rows', 'total_clicks', 'total_conversions')")


def _holey(spark: SparkSession, folder: str) -> DataFrame:
    """Split rows with nulls in a category: every row whose cat7 is 3 loses its cat4."""
    return split_log(spark, folder).withColumn("cat4", F.when(F.col("cat7") != 3, F.col("cat4")))


CLICK_PARTS = models.Features(numeric=("log_cost", "has_prev_click"), categorical=("cat4", "recency_bucket"))
EFFECT_PARTS = models.Features(numeric=("log_cost", "cpo_rank", "has_prev_click"), categorical=("cat4", "recency_bucket"))


def _short(df: DataFrame, *columns: str) -> DataFrame:
    """Fitted values at five digits: solvers agree to some ten."""
    return df.withColumns({name: F.round(name, 5) for name in columns})


def _train(df: DataFrame) -> DataFrame:
    return df.filter("split = 'train'")


def _click_logistic(spark: SparkSession, folder: str):
    """A logistic click model on rows of which some lack a category."""
    table = _holey(spark, folder)
    return table, models.fit_logistic(_train(table), CLICK_PARTS, "click")


def _logistic_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _short(models.coefficient_table(_click_logistic(spark, folder)[1], CLICK_PARTS), "coefficient")


def _ridge_fit(spark: SparkSession, folder: str) -> DataFrame:
    effect = _pseudo_outcome_column()
    rows = _train(uplift_table(spark, folder)).withColumn("effect_outcome", effect)
    model = models.fit_ridge(rows, EFFECT_PARTS, "effect_outcome", alpha=2.0)
    return _short(models.coefficient_table(model, EFFECT_PARTS), "coefficient")


def _uplift_linear(spark: SparkSession, folder: str) -> DataFrame:
    """All five scores of the linear uplift models on every row."""

    def build() -> DataFrame:
        spec = models.UpliftSpec(treatment_col=TREATMENT, outcome_col=OUTCOME, features=EFFECT_PARTS)
        table = uplift_table(spark, folder).drop("propensity_score", "treated_outcome_score", "control_outcome_score", *SCORES)
        return models.with_uplift_scores(table, models.fit_uplift(_train(table), spec), spec)

    return _once(spark, folder, "uplift-linear", build)


def _uplift_linear_scores(spark: SparkSession, folder: str) -> DataFrame:
    names = ("propensity_score", "treated_outcome_score", "control_outcome_score", *SCORES)
    return _short(_uplift_linear(spark, folder).select(*KEY, "split", *names), *names)


def _column_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """The source contract and the attribution contract on the log and on broken copies of it."""
    log = ad_log_table(spark, folder)
    copies = {
        "as given": log,
        "no campaign": log.drop("campaign"),
        "fractional uid": log.withColumn("uid", F.col("uid").cast("double")),
        "cost as text": log.withColumn("cost", F.col("cost").cast("string")),
    }
    needed = {name: "any" for name in attribution.REQUIRED_COLUMNS}
    parts = [verdicts.column_verdicts(df).withColumns({"copy": F.lit(name), "contract": F.lit("source")}) for name, df in copies.items()]
    lost = log.drop("click_pos", "conversion")
    parts += [
        verdicts.column_verdicts(df, needed).withColumns({"copy": F.lit(name), "contract": F.lit("attribution")})
        for name, df in {"as given": log, "no path": lost}.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _label_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Split rows of which some have lost their label or carry another one."""
    label = F.when(F.col("cat7") == 3, None).when((F.col("cat6") == 2) & (F.col("split") == "test"), 2).otherwise(F.col("click"))
    return verdicts.label_verdicts(split_log(spark, folder).withColumn("click", label), label_col="click", split_col="split")


def _calibration_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Scored clicks as they are, with holes, with other labels and scores, and none at all."""
    scored = click_scored(spark, folder)
    copies = {
        "as given": scored,
        "holes": scored.withColumn("pred_score", F.when(F.col("cat4") != 1, F.col("pred_score"))),
        "other values": scored.withColumns({"click": F.col("click") * 2, "pred_score": F.col("pred_score") * 2 - 0.5}),
        "empty": scored.filter("cost < 0"),
    }
    parts = [verdicts.calibration_verdicts(df, label_col="click", score_col="pred_score").withColumn("copy", F.lit(n)) for n, df in copies.items()]
    return reduce(DataFrame.unionByName, parts)


def _overlap_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark rows whose validation split has lost its treated rows."""
    table = uplift_table(spark, folder).filter((F.col("split") != "validation") | (F.col(TREATMENT) == 0))
    return verdicts.overlap_verdicts(table, treatment_col=TREATMENT, split_col="split")


STUMP_INPUTS = ("has_prev_click", "recency_bucket", "cat4", "cat6", "cpo", "cat9")


def _stump_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Every split of the root of a first tree for clicks, its gain and leaves, and whether it is the one taken."""
    rows = _train(split_log(spark, folder)).select(*[F.col(c).cast("double").alias(c) for c in STUMP_INPUTS], F.col("click").cast("double").alias("label"))
    rows = stage(rows, "stump")
    cuts = trees.cut_points(rows, STUMP_INPUTS)
    start = rows.agg(F.avg("label")).first()[0]
    binned = with_right_closed_bin(rows, {f"b{i}": (F.col(c), cuts[c]) for i, c in enumerate(STUMP_INPUTS)})
    curved = binned.withColumns({"node": F.lit(0), "g": F.lit(start) - F.col("label"), "h": F.lit(start * (1.0 - start))})
    gains = trees.split_gains(trees.histogram(curved, range(len(STUMP_INPUTS))))
    model = trees.fit_trees(rows, STUMP_INPUTS, "label", trees.TreeSettings(trees=1, depth=1, rate=1.0), probability=True)
    own, cut = model.trees["trees"][0]["splits"]["0"]
    names, listed = F.lit(list(STUMP_INPUTS)), F.lit([cuts[c] + [0.0] * (trees.MAX_BINS - len(cuts[c])) for c in STUMP_INPUTS])
    leaf = lambda side: F.round(-F.col(f"{side}_g") / (F.col(f"{side}_h") + trees.LEAF_PENALTY), 6)
    at = F.get(F.get(listed, F.col("input")), F.col("bin"))
    return gains.select(
        F.get(names, F.col("input")).alias("input"), at.alias("cut"), F.round("gain", 5).alias("gain"), leaf("left").alias("left_value"),
        leaf("right").alias("right_value"), ((F.col("input") == own) & (at == cut)).cast("int").alias("taken"),
    )


def _one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = encoding.one_hot_slots(_holey(spark, folder), ["cat4", "cat9", "campaign"])
    return rows.select(*KEY, F.concat_ws(",", F.col("slots").cast("array<string>")).alias("slots"))


def _click_linear_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a logistic click model on its splits, fitted, scored and evaluated."""
    table, model = _click_logistic(spark, folder)
    scored = stage(models.with_prediction(model, table, "pred_score"), "linear-clicks")
    # Equal features give equal scores in any engine only up to the order of sums.
    scored = scored.withColumn("pred_score", F.round("pred_score", 9))
    return evaluation.binary_metrics(scored, by=["split"], label_col="click", score_col="pred_score")


LINEAR_CANDIDATES = {
    "cost": models.Features(numeric=("log_cost", "has_prev_click"), categorical=("cat4",)),
    "recency": models.Features(numeric=("log_cost",), categorical=("recency_bucket", "cat6")),
}


def _click_linear_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Two logistic click models compared by the job: test metrics and four rankings."""
    candidates = {name: jobs.ClickJob(features=own, train_only_encodings=()) for name, own in LINEAR_CANDIDATES.items()}
    found = jobs.compare_click_models(ad_log_table(spark, folder), candidates)
    ranks = [name for name in found.columns if name.startswith("rank_")]
    numbers = ("roc_auc", "pr_auc", "log_loss", "brier_score")
    return _short(found, *numbers).select("name", "model_type", *numbers, *ranks, F.col("is_best").cast("int").alias("is_best"))


def _uplift_linear_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """The split summary of the linear uplift models."""
    names = ("propensity_score", "treated_outcome_score", "control_outcome_score", *SCORES)
    scored = _uplift_linear(spark, folder).withColumns({name: F.round(name, 9) for name in names})
    summary = jobs.uplift_evaluation(scored, _uplift_job())["uplift_summary"]
    return _short(summary, *[name for name, kind in summary.dtypes if kind == "double"])


def _model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a click model before it is saved and after it is read back, under its contract."""
    table, model = _click_logistic(spark, folder)
    target = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    artifacts.save_artifact(model, target, "click", trained_on=table, features=CLICK_PARTS, label="click")
    saved = artifacts.load_artifact(spark, target, "click")
    artifacts.check_columns(saved, table)
    before = models.with_prediction(model, table, "score_before")
    both = models.with_prediction(saved.model, before, "score_after")
    return _short(both.select(*KEY, "split", "score_before", "score_after"), "score_before", "score_after")


# Small boosted-tree settings: the fits below check the jobs end to end, not the best quality.
SMALL_TREES = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1}


def _click_model(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.run_click_model(ad_log_table(spark, folder), wanted=("click_metrics",))["click_metrics"]


def _model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.compare_click_models(
        ad_log_table(spark, folder),
        {
            "logistic": jobs.ClickJob(),
            "boosted_trees": jobs.ClickJob(model_type="boosted_trees", model_params=SMALL_TREES),
        },
    )


def _uplift_job() -> jobs.UpliftJob:
    return jobs.benchmark_job(learner="linear", max_iter=50)


def _uplift_scored(spark: SparkSession, folder: str) -> DataFrame:
    return _once(
        spark, folder, "uplift-model", lambda: jobs.score_uplift_table(ad_log_table(spark, folder), _uplift_job())[1]
    )


def _uplift_known_effect(spark: SparkSession, folder: str) -> DataFrame:
    return targeting.known_effect_report(
        _uplift_scored(spark, folder).filter("split = 'test'"), score_cols=SCORES, true_effect_col=EFFECT
    )


def _calibration_drift_model(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.run_calibration_drift(ad_log_table(spark, folder))["calibration_drift"]


def _catalog() -> dict[str, Query]:
    log = ad_log_table
    test_clicks = lambda s, d: click_scored(s, d).filter("split = 'test'")
    click = {"label_col": "click", "score_col": "pred_score"}
    uplift = {"treatment_col": TREATMENT, "outcome_col": OUTCOME, "score_cols": SCORES}
    return {
        # log building and attribution
        "ad_log": lambda s, d: ad_log(_table(s, d, "events")),
        "ad_log_missing_users": _missing_users,
        "attribution_credits": lambda s, d: attribution.with_credits(log(s, d)).select(
            *KEY, "last_touch", "multi_touch_linear", "time_decay"
        ),
        "attribution_campaign": lambda s, d: attribution.campaign_report(log(s, d)),
        "attribution_summary": lambda s, d: attribution.attribution_summary(log(s, d)),
        "attribution_decision": lambda s, d: attribution.decision_report(attribution.campaign_report(log(s, d))),
        "attribution_review_views": lambda s, d: attribution.review_views(
            attribution.decision_report(attribution.campaign_report(log(s, d))), top_campaigns=3
        ),
        "attribution_top_lists": lambda s, d: attribution.top_lists(
            attribution.campaign_report(log(s, d)), top_campaigns=5
        ),
        "budget_views": lambda s, d: attribution.budget_views(log(s, d), n=4),
        # contracts and profiles
        "quality_violations": lambda s, d: contracts.quality_violations(log(s, d)),
        "quality_violations_missing_users": lambda s, d: contracts.quality_violations(_missing_users(s, d)),
        "lineitem_quality_violations": _lineitem_duplicates,
        "table_profile": lambda s, d: profile.table_profile(
            log(s, d), mean_columns=("click", "conversion"),
            distinct_columns=("campaign", *[f"cat{i}" for i in range(1, 10)]),
        ),
        "describe_numeric": lambda s, d: profile.describe_numeric(
            log(s, d), ["cost", "cpo", "time_since_last_click"]
        ),
        "lineitem_describe_numeric": _lineitem_quartiles,
        "describe_numeric_with_nan": lambda s, d: profile.describe_numeric(
            _discount_with_nan(s, d), ["l_discount", "l_tax"]
        ),
        # sources
        "round_trip_csv": _round_trip(write_csv, ".csv"),
        "round_trip_tsv": _round_trip(write_tsv, ".tsv"),
        "round_trip_json": _round_trip(write_json, ".json"),
        "round_trip_parquet": _round_trip(write_parquet, ".parquet"),
        "runs_table": _runs,
        "contract_report": lambda s, d: contracts.contract_report(contracts.quality_violations(_missing_users(s, d))),
        "head_sample": lambda s, d: head_rows(_table(s, d, "orders"), 1000).select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
        ),
        "head_sample_by_key": lambda s, d: head_rows(log(s, d), 1000, order=[F.col(name) for name in KEY]).select(
            *KEY, "click", "cost"
        ),
        # features and ranks
        "click_features": lambda s, d: features.apply_feature_set(log(s, d), "ctr_notebook_v2").select(
            *KEY, "log_cost", "log_cpo", "time_since_last_click", "has_prev_click", "log_time_since_last_click",
            "recency_bucket",
        ),
        "rank_features": lambda s, d: features.add_rank_features(log(s, d)).select(
            *KEY, "cost_rank", "cpo_rank", "recency_rank"
        ),
        "lineitem_rank": lambda s, d: with_average_ranks(
            _table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"),
            {"quantity_rank": F.col("l_quantity"), "price_rank": F.col("l_extendedprice")},
            as_share=False,
        ),
        "expected_value_top": lambda s, d: features.expected_value_top(
            click_scored(s, d), score_col="pred_score"
        ).select(*KEY, "expected_value"),
        "cumulative_gain": lambda s, d: targeting.cumulative_gain(
            uplift_test(s, d), score_col="observational_score", outcome_col="conversion"
        ),
        # splits and selections
        "time_split": lambda s, d: splits.time_split(
            log(s, d), train_fraction=0.7, validation_fraction=0.1
        ).select(*KEY, "split"),
        "time_split_other_column": lambda s, d: splits.time_split(
            log(s, d), train_fraction=0.7, validation_fraction=0.1, order=splits.split_order("cost")
        ).select(*KEY, "split"),
        "time_split_two_way": lambda s, d: splits.time_split(log(s, d), train_fraction=0.8)
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")),
        "time_slices": lambda s, d: splits.with_time_slice(log(s, d), slices=7).select(*KEY, "time_slice"),
        "random_selection": lambda s, d: splits.random_selection(log(s, d), (0.01, 0.1, 0.3), seed=42).select(
            *KEY, "smallest_fraction"
        ),
        # encodings and imputation
        "campaign_encoding": lambda s, d: encoding.encode_campaign(split_log(s, d), label_col="click").select(
            *KEY, "campaign_ctr"
        ),
        "encoding_metadata": lambda s, d: encoding.encoding_metadata(
            split_log(s, d), label_col="click", campaign_col="cat9"
        ),
        "impute": lambda s, d: encoding.impute(
            _holey(s, d), numeric=["time_since_last_click"], categorical=["cat4"]
        ).select(*KEY, "time_since_last_click", "cat4"),
        "ordinal_encode": lambda s, d: encoding.ordinal_encode(split_log(s, d), ["cat9", "campaign"]).select(
            "timestamp", "uid", "cat9", "campaign"
        ),
        # evaluation
        "binary_metrics": lambda s, d: evaluation.binary_metrics(click_scored(s, d), by=["split"], **click),
        "calibration_bins": lambda s, d: evaluation.calibration_bins(test_clicks(s, d), **click),
        "calibration_summary": lambda s, d: evaluation.calibration_summary(
            evaluation.calibration_bins(test_clicks(s, d), **click)
        ),
        "campaign_slices": lambda s, d: evaluation.campaign_slices(test_clicks(s, d), top_campaigns=4, **click),
        "time_slice_metrics": _click_time_slices,
        "propensity_metrics": lambda s, d: evaluation.binary_metrics(
            uplift_table(s, d), label_col=TREATMENT, score_col="propensity_score", by=["split"]
        ),
        # benchmark and uplift diagnostics
        "known_effect_columns": lambda s, d: uplift_table(s, d).select(
            *KEY, TREATMENT, OUTCOME, EFFECT, f"{TREATMENT}_propensity", f"{OUTCOME}_probability",
            "baseline_outcome_probability",
        ),
        "hash_draws": lambda s, d: log(s, d).select(*KEY, hash_uniform(7, KEY, "t").alias("draw")),
        "ranking_diagnostics": lambda s, d: targeting.ranking_diagnostics(uplift_test(s, d), **uplift),
        "policy_curve": lambda s, d: targeting.policy_curve(uplift_test(s, d), **uplift),
        "known_effect_report": lambda s, d: targeting.known_effect_report(
            uplift_test(s, d), score_cols=SCORES, true_effect_col=EFFECT
        ),
        "score_correlation": lambda s, d: targeting.score_correlation(uplift_test(s, d), *SCORES),
        "dr_pseudo_outcome": _pseudo_outcome,
        # targeting
        "policy_table": _policies,
        "policy_comparison": lambda s, d: targeting.policy_comparison(
            _policies(s, d), preferred_score_col="doubly_robust_score"
        ),
        "policy_recommendation": lambda s, d: targeting.policy_recommendation(
            targeting.policy_comparison(_policies(s, d), preferred_score_col="doubly_robust_score")
        ),
        "batch_scores": _batch_scores,
        "batch_summary": lambda s, d: targeting.batch_summary(
            _batch_scores(s, d), preferred_score_col="doubly_robust_score", true_effect_col=EFFECT
        ),
        # drift
        "numeric_drift": _numeric_drift,
        "categorical_drift": _categorical_drift,
        "drift_summary": _drift_summary,
        "lineitem_numeric_drift": lambda s, d: drift.numeric_drift(
            *_lineitem_sides(s, d), columns=("l_quantity", "l_extendedprice", "l_discount"), bins=10
        ),
        "lineitem_categorical_drift": lambda s, d: drift.categorical_drift(
            *_lineitem_sides(s, d), columns=("l_returnflag", "l_linestatus", "l_suppkey"), top_n=20
        ),
        "calibration_drift_bins": lambda s, d: calibration.calibration_drift_bins(_calibration_totals(s, d)),
        "calibration_drift": lambda s, d: calibration.calibration_drift_summary(_calibration_totals(s, d)),
        # fits from sufficient statistics
        "ridge_fit": _ridge_fit,
        "logistic_fit": _logistic_fit,
        "uplift_linear_scores": _uplift_linear_scores,
        "click_linear_metrics": _click_linear_metrics,
        "click_linear_comparison": _click_linear_comparison,
        "uplift_linear_evaluation": _uplift_linear_evaluation,
        "one_hot": _one_hot,
        "stump_fit": _stump_fit,
        # refusals as rows
        "column_verdicts": _column_verdicts,
        "label_verdicts": _label_verdicts,
        "calibration_verdicts": _calibration_verdicts,
        "overlap_verdicts": _overlap_verdicts,
        "split_verdicts": lambda s, d: verdicts.split_verdicts(log(s, d), [(0.7, 0.1), (0.8, 0.0), (0.9, 0.1), (0.5, 0.6), (0.0, 0.1), (0.6, -0.1)]),
        "model_round_trip": _model_round_trip,
        # fitted models: many features or trees, no SQL equivalent
        "click_model_metrics": _click_model,
        "click_model_comparison": _model_comparison,
        "uplift_model_scores": lambda s, d: _uplift_scored(s, d).select(
            *KEY, "split", "propensity_score", "treated_outcome_score", "control_outcome_score", *SCORES
        ),
        "uplift_model_evaluation": lambda s, d: jobs.uplift_evaluation(_uplift_scored(s, d), _uplift_job())[
            "uplift_summary"
        ],
        "uplift_model_known_effect": _uplift_known_effect,
        "calibration_drift_model": _calibration_drift_model,
    }


def named_queries() -> dict[str, Query]:
    """Every query with comparable output types."""
    return {name: (lambda s, d, q=query: tidy(q(s, d))) for name, query in _catalog().items()}

