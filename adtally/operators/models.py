"""Click and uplift models as Spark ML pipelines.

A fitted model is one saved-and-loadable PipelineModel: imputation with training statistics, category codes
joined from a written table, assembling and the estimator. Scoring is a plain `transform`. Linear fits of up to
`linear.MAX_SLOTS` features come from sufficient statistics; wider ones, and trees, from Spark's own solvers on
sparse vectors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.expressions import clip
from adtally.operators import linear, trees
from adtally.operators.coding import CategoryCodes
from adtally.operators.contracts import check_overlap
from adtally.operators.encoding import most_frequent
from adtally.operators.selection import medians
from adtally.sources.staging import release, stage

# Default boosted-tree settings of the click model and of the uplift models.
CLICK_TREE_DEFAULTS = {
    "n_estimators": 200, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8,
    "random_state": 42,
}
UPLIFT_TREE_DEFAULTS = {
    "n_estimators": 100, "max_depth": 3, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8,
    "random_state": 42,
}


@dataclass(frozen=True)
class Features:
    numeric: Sequence[str]
    categorical: Sequence[str]


@dataclass(frozen=True)
class UpliftSpec:
    treatment_col: str
    outcome_col: str
    features: Features
    propensity_clip: float = 0.05
    max_iter: int = 100
    ridge_alpha: float = 1.0
    learner: str = "linear"
    learner_params: Mapping[str, Any] = field(default_factory=dict)


def _filled_inputs(train: DataFrame, features: Features) -> SQLTransformer:
    """Fills nulls with training medians and modes."""
    fills = medians(train, {name: F.col(name) for name in features.numeric}) if features.numeric else {}
    modes = most_frequent(train, features.categorical)
    empty = [name for name in features.numeric if fills[name] is None]
    empty += [name for name in features.categorical if modes[name] is None]
    if empty:
        raise ValueError(f"training columns without any value: {empty}")
    parts = [
        f"CAST(COALESCE(CAST(`{name}` AS DOUBLE), {fills[name]!r}D) AS DOUBLE) AS `num_{name}`"
        for name in features.numeric
    ]
    parts += [f"COALESCE(CAST(`{name}` AS BIGINT), {modes[name]}L) AS `cat_{name}`" for name in features.categorical]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _coded(stages: Sequence, features: Features) -> tuple[list[str], list[int]]:
    """The code columns and their number of codes, as fitted in the preparation stages."""
    codes = next((s for s in stages if isinstance(s, CategoryCodes)), None)
    return ([f"idx_cat_{name}" for name in features.categorical], codes.getOrDefault(codes.sizes)) if codes else ([], [])


def _preparation(train: DataFrame, features: Features, *, one_hot: bool, codes: CategoryCodes | None = None) -> list:
    """Fitted stages from raw columns to the `features` vector.

    Given codes may know more values than `train` has: under a penalty their coefficients are zero, as if unknown.
    """
    stages = [_filled_inputs(train, features)]
    inputs = [f"num_{name}" for name in features.numeric]
    if features.categorical:
        # Codes follow numeric order; values never trained on get the code after the last.
        texts = [f"cat_{name}" for name in features.categorical]
        stages.append(codes or CategoryCodes.fit(stages[0].transform(train), texts))
        columns, sizes = _coded(stages, features)
        if one_hot:
            # The dropped last slot is the one of unknown values: they become all-zero vectors.
            vectors = [f"hot_{name}" for name in features.categorical]
            encoder = OneHotEncoder(inputCols=columns, outputCols=vectors, dropLast=True, handleInvalid="error")
            # The encoder only needs the largest code of each column: one made row holds them.
            largest = train.sparkSession.createDataFrame([tuple(sizes)], ", ".join(f"`{name}` int" for name in columns))
            stages.append(encoder.fit(largest))
            inputs += vectors
        else:
            # Plain numbers, -1 for unknown: trees then split by order instead of by category sets.
            parts = [
                f"CASE WHEN `{column}` = {size} THEN -1D ELSE CAST(`{column}` AS DOUBLE) END AS `ord_{name}`"
                for name, column, size in zip(features.categorical, columns, sizes, strict=True)
            ]
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"))
            inputs += [f"ord_{name}" for name in features.categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def _fit_linear(train: DataFrame, features: Features, label_col: str, stages: Sequence, *, solve, wide, probability: bool) -> PipelineModel:
    """The model solved from sums where its features are few enough, else by the iterative estimator `wide`."""
    layout = linear.Layout([f"num_{name}" for name in features.numeric], *_coded(stages, features))
    label = F.col(label_col).cast("double")
    if layout.width > linear.MAX_SLOTS:
        return _fit(train, stages, label_col, wide)
    ready = [s for s in stages if not isinstance(s, VectorAssembler) and "hot_" not in str(getattr(s, "getOutputCols", list)())]
    # Every pass rereads the coded rows, and only them.
    rows = PipelineModel(ready).transform(train).select(*layout.numeric, *layout.codes, label.alias("__label"))
    rows = stage(rows.filter(F.col("__label").isNotNull()), "coded-rows")
    fitted = linear.LinearScorer(layout, *solve(rows, layout), probability=probability)
    release(rows)
    return PipelineModel([*stages, fitted])


def _tree_settings(params: Mapping[str, Any], label_col: str) -> dict[str, Any]:
    return {
        "featuresCol": "features",
        "labelCol": label_col,
        "maxIter": int(params["n_estimators"]),
        "maxDepth": int(params["max_depth"]),
        "stepSize": float(params["learning_rate"]),
        "subsamplingRate": float(params["subsample"]),
        "featureSubsetStrategy": str(float(params["colsample_bytree"])),
        "seed": int(params["random_state"]),
        "maxBins": 256,
    }


def _fit(train: DataFrame, stages: Sequence, label_col: str, estimator) -> PipelineModel:
    """An estimator fitted on the prepared vectors of `train`."""
    label = F.col(label_col).cast("double").alias(label_col)
    prepared = PipelineModel(list(stages)).transform(train).select("features", label)
    # Every solver iteration rereads the prepared vectors.
    prepared.persist()
    try:
        fitted = estimator(prepared).fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel([*stages, fitted])


def _codes_of(model: PipelineModel) -> CategoryCodes | None:
    return next((s for s in model.stages if isinstance(s, CategoryCodes)), None)


def fit_logistic(
    train: DataFrame,
    features: Features,
    label_col: str,
    *,
    max_iter: int = 100,
    penalty_c: float = 1.0,
    codes: CategoryCodes | None = None,
) -> PipelineModel:
    """L2-penalised logistic regression with a free intercept.

    Spark's solver averages the loss over rows, so its penalty is 1 / (C n).
    """

    def wide(prepared: DataFrame):
        return LogisticRegression(
            featuresCol="features",
            labelCol=label_col,
            maxIter=max_iter,
            regParam=1.0 / (penalty_c * prepared.count()),
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-8,
        )

    def solve(rows: DataFrame, layout: linear.Layout):
        return linear.solve_logistic(rows, layout, "__label", penalty=1.0 / penalty_c, max_iter=max_iter)

    stages = _preparation(train, features, one_hot=True, codes=codes)
    return _fit_linear(train, features, label_col, stages, solve=solve, wide=wide, probability=True)


def fit_boosted_classifier(
    train: DataFrame, features: Features, label_col: str, params: Mapping[str, Any] | None = None
) -> PipelineModel:
    settings = _tree_settings(CLICK_TREE_DEFAULTS | dict(params or {}), label_col)
    return _fit(train, _preparation(train, features, one_hot=False), label_col, lambda _: GBTClassifier(**settings))


def _fit_histogram_trees(
    train: DataFrame, stages: Sequence, label_col: str, params: Mapping[str, Any], *, probability: bool
) -> PipelineModel:
    """Second-order boosted trees on the inputs of the prepared vector."""
    inputs = stages[-1].getInputCols()
    rows = PipelineModel(list(stages[:-1])).transform(train).select(*inputs, F.col(label_col).cast("double").alias("__label"))
    rows = stage(rows.filter(F.col("__label").isNotNull()), "tree-rows")
    fitted = trees.fit_trees(rows, inputs, "__label", trees.TreeSettings.of(params), probability=probability)
    release(rows)
    return PipelineModel([*stages, fitted])


def fit_click_model(
    train: DataFrame,
    features: Features,
    label_col: str,
    *,
    model_type: str = "logistic_regression",
    params: Mapping[str, Any] | None = None,
) -> PipelineModel:
    params = dict(params or {})
    if model_type == "logistic_regression":
        return fit_logistic(
            train, features, label_col, max_iter=int(params.get("max_iter", 100)), penalty_c=float(params.get("C", 1.0))
        )
    if model_type == "boosted_trees":
        return fit_boosted_classifier(train, features, label_col, params)
    if model_type == "histogram_trees":
        stages = _preparation(train, features, one_hot=False)
        return _fit_histogram_trees(train, stages, label_col, CLICK_TREE_DEFAULTS | params, probability=True)
    raise ValueError(f"Unsupported model_type: {model_type}")


def with_prediction(model: PipelineModel, df: DataFrame, output: str) -> DataFrame:
    """Add the model's probability of label 1 (or its predicted value) as one column, all helpers dropped."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        value = vector_to_array("probability").getItem(1)
    else:
        value = F.col("prediction")
    return scored.withColumn("model_output", value).select(
        *[F.col(name) for name in df.columns if name != output], F.col("model_output").alias(output)
    )


def _constant(probability: float) -> PipelineModel:
    """A model that always predicts one probability."""
    limited = min(max(float(probability), 0.0), 1.0)
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {limited!r}D AS prediction FROM __THIS__")])


def _classifier(train: DataFrame, spec: UpliftSpec, label_col: str, codes: CategoryCodes | None = None) -> PipelineModel:
    if spec.learner == "linear":
        return fit_logistic(train, spec.features, label_col, max_iter=spec.max_iter, codes=codes)
    if spec.learner == "boosted_trees":
        settings = UPLIFT_TREE_DEFAULTS | dict(spec.learner_params)
        return fit_boosted_classifier(train, spec.features, label_col, settings)
    if spec.learner == "histogram_trees":
        settings = UPLIFT_TREE_DEFAULTS | dict(spec.learner_params)
        return _fit_histogram_trees(train, _preparation(train, spec.features, one_hot=False), label_col, settings, probability=True)
    raise ValueError(f"Unsupported uplift learner: {spec.learner}")


def _outcome_model(rows: DataFrame, spec: UpliftSpec, codes: CategoryCodes | None = None) -> PipelineModel:
    outcome = F.col(spec.outcome_col).cast("double")
    found = rows.agg(F.avg(outcome).alias("rate"), F.min(outcome).alias("low"), F.max(outcome).alias("high")).first()
    if found["low"] == found["high"]:
        return _constant(found["rate"])
    return _classifier(rows, spec, spec.outcome_col, codes)


def fit_ridge(
    train: DataFrame, features: Features, label_col: str, *, alpha: float = 1.0, like: PipelineModel | None = None
) -> PipelineModel:
    """Least squares with an L2 penalty of alpha on the squared-error sum.

    A model fitted on the same rows and features may lend its preparation stages. Spark's solver minimises the
    mean error of the label divided by its deviation, so its penalty is alpha times that deviation over n.
    """

    def wide(prepared: DataFrame):
        stats = prepared.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(label_col).alias("spread")).first()
        return LinearRegression(
            featuresCol="features",
            labelCol=label_col,
            solver="l-bfgs",
            regParam=alpha * (stats["spread"] or 0.0) / stats["n"],
            elasticNetParam=0.0,
            standardization=False,
            maxIter=500,
            tol=1e-10,
        )

    def solve(rows: DataFrame, layout: linear.Layout):
        return linear.solve_ridge(rows, layout, "__label", alpha=alpha)

    stages = _preparation(train, features, one_hot=True) if like is None else like.stages[:-1]
    return _fit_linear(train, features, label_col, stages, solve=solve, wide=wide, probability=False)


def _effect_model(train: DataFrame, spec: UpliftSpec, label_col: str, like: PipelineModel) -> PipelineModel:
    if spec.learner == "linear":
        return fit_ridge(train, spec.features, label_col, alpha=spec.ridge_alpha, like=like)
    params = UPLIFT_TREE_DEFAULTS | dict(spec.learner_params)
    if spec.learner == "histogram_trees":
        return _fit_histogram_trees(train, like.stages[:-1], label_col, params, probability=False)
    settings = _tree_settings(params, label_col)
    return _fit(train, like.stages[:-1], label_col, lambda _: GBTRegressor(**settings))


def doubly_robust_outcome(
    *, treatment: Column, outcome: Column, propensity: Column, treated_score: Column, control_score: Column
) -> Column:
    """Effect estimate of one row: the models' difference plus the weighted error of the arm that was seen."""
    t, e = treatment.cast("double"), propensity
    seen = F.when(t == 1.0, treated_score).otherwise(control_score)
    weight = (t - e) / (e * (1.0 - e))
    return weight * (outcome.cast("double") - seen) + (treated_score - control_score)


def _with_nuisances(df: DataFrame, models: Mapping[str, PipelineModel], spec: UpliftSpec) -> DataFrame:
    df = with_prediction(models["propensity_model"], df, "propensity_score")
    df = with_prediction(models["treated_outcome_model"], df, "treated_outcome_score")
    df = with_prediction(models["control_outcome_model"], df, "control_outcome_score")
    c = spec.propensity_clip
    return df.withColumn("propensity_score", clip(F.col("propensity_score"), c, 1.0 - c))


def fit_uplift(train: DataFrame, spec: UpliftSpec) -> dict[str, PipelineModel]:
    """Propensity model, one outcome model per arm, and an effect model on the doubly robust outcome."""
    check_overlap(train, spec.treatment_col)
    treated = train.filter(F.col(spec.treatment_col) == 1)
    control = train.filter(F.col(spec.treatment_col) == 0)
    models = {"propensity_model": _classifier(train, spec, spec.treatment_col)}
    # The arms' categories are among those of all training rows.
    codes = _codes_of(models["propensity_model"]) if spec.learner == "linear" else None
    models["treated_outcome_model"] = _outcome_model(treated, spec, codes)
    models["control_outcome_model"] = _outcome_model(control, spec, codes)
    effect = doubly_robust_outcome(
        treatment=F.col(spec.treatment_col),
        outcome=F.col(spec.outcome_col),
        propensity=F.col("propensity_score"),
        treated_score=F.col("treated_outcome_score"),
        control_score=F.col("control_outcome_score"),
    )
    # Written once: the effect model's fit would otherwise score three models again in every pass.
    with_effect = stage(_with_nuisances(train, models, spec).withColumn("effect_outcome", effect), "effect")
    # The propensity model saw the same rows and features: its imputation and encoding are reused.
    return models | {"tau_model": _effect_model(with_effect, spec, "effect_outcome", models["propensity_model"])}


def with_uplift_scores(df: DataFrame, models: Mapping[str, PipelineModel], spec: UpliftSpec) -> DataFrame:
    """Adds propensity, both outcome scores, their difference, and the doubly robust score."""
    scored = _with_nuisances(df, models, spec).withColumn(
        "observational_score", F.col("treated_outcome_score") - F.col("control_outcome_score")
    )
    return with_prediction(models["tau_model"], scored, "doubly_robust_score")


def coefficient_table(model: PipelineModel, features: Features) -> DataFrame:
    """(feature, coefficient) of a linear model solved from sums: the intercept, numeric columns, and name=value per category."""
    fitted, codes = model.stages[-1], _codes_of(model)
    if not isinstance(fitted, linear.LinearScorer):
        raise ValueError("the model's coefficients do not come from sums")
    layout, values = fitted.layout, [float(c) for c in fitted.coefficients.toArray()]
    spark = SparkSession.active()
    rows = [("intercept", fitted.intercept), *zip(features.numeric, values, strict=False)]
    table = spark.createDataFrame([(name, float(value)) for name, value in rows], "feature string, coefficient double")
    for name, size, start in zip(features.categorical, layout.sizes, layout.offsets(), strict=True):
        own = codes.codes.filter(F.col("name") == f"cat_{name}")
        slots = F.lit(values[start : start + size])
        table = table.unionByName(
            own.select(F.concat(F.lit(f"{name}="), F.col("value")).alias("feature"), F.get(slots, F.col("code").cast("int")).alias("coefficient"))
        )
    return table


def save_models(models: Mapping[str, PipelineModel], folder: str) -> None:
    """One saved model per name."""
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/{name}")
