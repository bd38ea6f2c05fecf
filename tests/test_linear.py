import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.operators import artifacts, linear
from adtally.operators import models as M
from adtally.operators.coding import CategoryCodes
from tests.test_models import FEATURES, design, table


def test_ridge_is_the_closed_form_to_many_digits(spark):
    df = table(spark).withColumn("x", F.col("x") * 1e6 + 3e7)
    model = M.fit_ridge(df, FEATURES, "target", alpha=2.0)
    X, y = design(df, "target")
    Xc, yc = X - X.mean(0), y - y.mean()
    want = np.linalg.solve(Xc.T @ Xc + 2.0 * np.eye(X.shape[1]), Xc.T @ yc)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), want, rtol=1e-7, atol=1e-12)
    got = M.with_prediction(model, df, "p").orderBy("id").toPandas().p.to_numpy()
    np.testing.assert_allclose(got, y.mean() + Xc @ want, atol=1e-8)


def test_logistic_gradient_vanishes(spark):
    df = table(spark)
    model = M.fit_logistic(df, FEATURES, "y", penalty_c=0.5)
    X, y = design(df, "y")
    w = model.stages[-1].coefficients.toArray()
    scores = M.with_prediction(model, df, "p").orderBy("id").toPandas().p.to_numpy()
    assert np.abs(w / 0.5 + X.T @ (scores - y)).max() < 1e-6
    assert abs((scores - y).sum()) < 1e-6


def test_separable_labels_stay_finite(spark):
    df = table(spark).withColumn("y", (F.col("z") > 0).cast("int"))
    model = M.fit_logistic(df, M.Features(["z"], []), "y")
    X, y = design(df, "y")
    p = M.with_prediction(model, df, "p").orderBy("id").toPandas().p.to_numpy()
    w = model.stages[-1].coefficients.toArray()
    assert np.isfinite(w).all() and abs(w[0] + X[:, 1] @ (p - y)) < 1e-6


def test_wide_and_narrow_fits_agree(spark, monkeypatch):
    df = table(spark)
    narrow = M.fit_logistic(df, FEATURES, "y")
    ridge = M.fit_ridge(df, FEATURES, "target")
    monkeypatch.setattr(linear, "MAX_SLOTS", 3)
    wide = M.fit_logistic(df, FEATURES, "y", max_iter=300)
    wide_ridge = M.fit_ridge(df, FEATURES, "target")
    assert not isinstance(wide.stages[-1], linear.LinearScorer)
    np.testing.assert_allclose(wide.stages[-1].coefficients.toArray(), narrow.stages[-1].coefficients.toArray(), atol=2e-3)
    np.testing.assert_allclose(wide_ridge.stages[-1].coefficients.toArray(), ridge.stages[-1].coefficients.toArray(), atol=2e-3)
    with pytest.raises(ValueError, match="do not come from sums"):
        M.coefficient_table(wide, FEATURES)


def test_categories_are_open(spark, tmp_path):
    """A column with 300,000 categories fits, saves, loads and scores; nothing of it passes the driver but coefficients."""
    rows = spark.range(300_000).select(
        F.col("id"), (F.col("id") * 7).alias("c"), (F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y")
    )
    features = M.Features(["x"], ["c"])
    model = M.fit_logistic(rows, features, "y", max_iter=3)
    codes = next(s for s in model.stages if isinstance(s, CategoryCodes))
    assert codes.getOrDefault(codes.sizes) == [300_000] and codes.codes.count() == 300_000
    version = artifacts.save_artifact(model, str(tmp_path), "wide", trained_on=rows, features=features, label="y")
    loaded = artifacts.load_artifact(spark, str(tmp_path), "wide", version).model
    probe = spark.createDataFrame([(1.0, 0), (1.0, 1), (0.0, 21)], "x double, c long")
    before = [r.p for r in M.with_prediction(model, probe, "p").collect()]
    assert before == [r.p for r in M.with_prediction(loaded, probe, "p").collect()] and len(before) == 3


def test_unused_and_unknown_categories(spark):
    df = table(spark)
    model = M.fit_logistic(df, FEATURES, "y")
    codes = next(s for s in model.stages if isinstance(s, CategoryCodes))
    part = M.fit_logistic(df.filter("c <> 7 or c is null"), FEATURES, "y", codes=codes)
    coefficients = {r.feature: r.coefficient for r in M.coefficient_table(part, FEATURES).collect()}
    assert abs(coefficients["c=7"]) < 1e-12 and coefficients["c=5"] != 0.0 and len(coefficients) == 10
    probe = spark.createDataFrame([(0.5, 0.5, v) for v in (7, 999)], "x double, z double, c long")
    a, b = (r.p for r in M.with_prediction(part, probe, "p").collect())
    assert a == pytest.approx(b)


def test_artifact_versions_and_contract(spark, tmp_path):
    df = table(spark)
    model = M.fit_logistic(df, FEATURES, "y")
    folder = str(tmp_path)
    save = lambda: artifacts.save_artifact(model, folder, "click", trained_on=df, features=FEATURES, label="y")
    assert [save(), save()] == [1, 2]
    (tmp_path / "click" / "v3" / "model").mkdir(parents=True)  # a save that never ended
    found = artifacts.load_artifact(spark, folder, "click")
    assert (found.version, found.label, found.types["c"]) == (2, "y", "bigint")
    assert save() == 4 and artifacts.load_artifact(spark, folder, "click", 1).version == 1
    scored = M.with_prediction(found.model, df, "p").orderBy("id").collect()
    assert [r.p for r in scored] == [r.p for r in M.with_prediction(model, df, "p").orderBy("id").collect()]
    artifacts.check_columns(found, df.withColumn("x", F.col("x").cast("float")))
    with pytest.raises(ValueError, match="lacks: \\['z'\\]"):
        artifacts.check_columns(found, df.drop("z"))
    with pytest.raises(ValueError, match="another kind"):
        artifacts.check_columns(found, df.withColumn("c", F.col("c").cast("string")))
    with pytest.raises(ValueError, match="another kind"):
        artifacts.check_columns(found, df.withColumn("c", F.col("c").cast("double")))
    for missing in ({"name": "other"}, {"name": "click", "version": 3}):
        with pytest.raises(ValueError, match="no saved model"):
            artifacts.load_artifact(spark, folder, **missing)


def test_empty_and_constant_columns(spark):
    df = table(spark).withColumn("k", F.lit(4.0)).withColumn("nothing", F.lit(None).cast("double"))
    model = M.fit_ridge(df, M.Features(["k", "z"], []), "target", alpha=1.0)
    k, z = model.stages[-1].coefficients.toArray()
    assert abs(k) < 1e-9 and abs(z) > 0
    with pytest.raises(ValueError, match="without any value"):
        M.fit_ridge(df, M.Features(["nothing"], []), "target")
