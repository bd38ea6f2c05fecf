import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from adtally.operators import models as M

FEATURES = M.Features(numeric=["x", "z"], categorical=["c"])


def table(spark, rows=400):
    rng = np.random.default_rng(8)
    x, z, c = rng.normal(size=rows), rng.normal(size=rows), rng.integers(5, 12, rows)
    y = (rng.random(rows) < 1 / (1 + np.exp(-(0.8 * x - 0.5 * z + 0.3 * (c % 3))))).astype(int)
    t = rng.integers(0, 2, rows)
    data = [
        (i, float(x[i]) if i % 10 else None, float(z[i]), int(c[i]) if i % 7 else None, int(y[i]), int(t[i]), float(2.0 * x[i] + t[i]))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "id int, x double, z double, c long, y int, t int, target double").repartition(3)


def design(df, label):
    """Imputed and one-hot encoded matrix, computed by hand."""
    pdf = df.orderBy("id").toPandas()
    x = pdf.x.fillna(pdf.x.median())
    c = pdf.c.fillna(pdf.c.mode().min()).astype(int)
    hot = np.stack([(c == value).astype(float) for value in sorted(c.unique())], axis=1)
    return np.column_stack([x, pdf.z, hot]), pdf[label].to_numpy(float)


def test_logistic_solves_the_penalised_problem(spark):
    df = table(spark)
    model = M.fit_logistic(df, FEATURES, "y", max_iter=300)
    X, y = design(df, "y")
    scores = M.with_prediction(model, df, "p").orderBy("id").toPandas().p.to_numpy()
    fitted = model.stages[-1]
    w = fitted.coefficients.toArray()
    np.testing.assert_allclose(scores, 1 / (1 + np.exp(-(X @ w + fitted.intercept))), atol=1e-9)
    # gradient of 0.5 |w|^2 + sum of log losses vanishes, the intercept is free
    assert np.abs(w + X.T @ (scores - y)).max() < 0.02
    assert abs((scores - y).sum()) < 0.02


def test_ridge_matches_the_closed_form(spark):
    df = table(spark)
    model = M.fit_ridge(df, FEATURES, "target", alpha=2.0)
    X, y = design(df, "target")
    Xc, yc = X - X.mean(0), y - y.mean()
    want = np.linalg.solve(Xc.T @ Xc + 2.0 * np.eye(X.shape[1]), Xc.T @ yc)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), want, atol=1e-3)


def test_unknown_category_is_an_all_zero_vector(spark):
    df = table(spark)
    model = M.fit_logistic(df, FEATURES, "y")
    row = model.transform(spark.createDataFrame([(0.0, 0.0, 999)], "x double, z double, c long")).first()
    assert row["features"].toArray().tolist() == [0.0] * len(row["features"])


def test_tree_codes_follow_numeric_order_and_unknown_is_minus_one(spark):
    df = table(spark, 60)
    model = M.fit_boosted_classifier(df, FEATURES, "y", {"n_estimators": 2, "max_depth": 2})
    probe = spark.createDataFrame([(0.0, 0.0, v) for v in (5, 6, 11, 999)], "x double, z double, c long")
    assert [r["ord_c"] for r in model.transform(probe).collect()] == [0.0, 1.0, 6.0, -1.0]


def test_boosted_trees_separate(spark):
    df = table(spark).withColumn("y", (F.col("z") > 0).cast("int"))
    model = M.fit_click_model(df, FEATURES, "y", model_type="boosted_trees", params={"n_estimators": 5, "max_depth": 2})
    scored = M.with_prediction(model, df, "p")
    assert scored.columns == [*df.columns, "p"]
    means = {r.y: r.m for r in scored.groupBy("y").agg(F.avg("p").alias("m")).collect()}
    assert means[1] > 0.7 > 0.3 > means[0]
    with pytest.raises(ValueError, match="Unsupported model_type"):
        M.fit_click_model(df, FEATURES, "y", model_type="other")


def test_uplift_models_and_saving(spark, tmp_path):
    df = table(spark)
    spec = M.UpliftSpec(treatment_col="t", outcome_col="y", features=FEATURES)
    models = M.fit_uplift(df, spec)
    scored = M.with_uplift_scores(df, models, spec)
    rows = scored.collect()
    assert all(0.05 <= r.propensity_score <= 0.95 for r in rows)
    assert all(
        r.observational_score == pytest.approx(r.treated_outcome_score - r.control_outcome_score) for r in rows
    )
    M.save_models(models, str(tmp_path))
    loaded = PipelineModel.load(f"{tmp_path}/tau_model")
    again = {r.id: r.s for r in M.with_prediction(loaded, df, "s").collect()}
    assert all(again[r.id] == pytest.approx(r.doubly_robust_score) for r in rows)


def test_one_class_outcome_gives_a_constant(spark):
    df = table(spark).withColumn("y", F.when(F.col("t") == 1, 1).otherwise(F.col("y")))
    spec = M.UpliftSpec(treatment_col="t", outcome_col="y", features=FEATURES)
    models = M.fit_uplift(df, spec)
    assert {r.p for r in M.with_prediction(models["treated_outcome_model"], df, "p").select("p").distinct().collect()} == {1.0}
    with pytest.raises(ValueError, match="both treated and control"):
        M.fit_uplift(df.filter("t = 1"), spec)


def test_pseudo_outcome(spark):
    df = spark.createDataFrame([(1, 1, 0.5, 0.6, 0.2), (0, 1, 0.25, 0.6, 0.2)], "t int, y int, e double, a double, b double")
    column = M.doubly_robust_outcome(
        treatment=F.col("t"), outcome=F.col("y"), propensity=F.col("e"), treated_score=F.col("a"), control_score=F.col("b")
    )
    got = [r[0] for r in df.select(column).collect()]
    assert got == pytest.approx([2 * 0.4 + 0.4, (-0.25 / 0.1875) * 0.8 + 0.4])
