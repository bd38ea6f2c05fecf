import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from adtally.operators import models as M
from adtally.operators import trees
from tests.test_models import FEATURES, table

SETTINGS = trees.TreeSettings(trees=3, depth=2, rate=0.5)


def plain_tree(X, g, h, depth):
    """One tree by trying every cut of every column, as leaf values per row."""
    out = np.zeros(len(g))

    def grow(rows, level):
        best = (0.0, None, None)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for i in range(X.shape[1] if level < depth else 0):
            for cut in np.unique(X[:, i])[:-1]:
                left = rows & (X[:, i] <= cut)
                right = rows & ~left
                if not left.any() or not right.any() or min(h[left].sum(), h[right].sum()) < 1:
                    continue
                gain = round(0.5 * (g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1) - whole), 9)
                if gain > best[0]:
                    best = (gain, left, right)
        if best[1] is None:
            out[rows] = -g[rows].sum() / (h[rows].sum() + 1)
        else:
            grow(best[1], level + 1)
            grow(best[2], level + 1)

    grow(np.ones(len(g), bool), 0)
    return out


@pytest.mark.parametrize("probability", [True, False])
def test_trees_equal_a_search_over_all_cuts(spark, probability):
    rng = np.random.default_rng(2)
    X = rng.integers(0, 9, (300, 3)).astype(float)
    y = (X[:, 0] + X[:, 1] * X[:, 2] + rng.normal(size=300) > 18).astype(float) if probability else X[:, 0] * 2 - X[:, 2] + rng.normal(size=300)
    df = spark.createDataFrame([(i, *map(float, x), float(t)) for i, (x, t) in enumerate(zip(X, y))], "id int, a double, b double, c double, y double")
    model = trees.fit_trees(df.repartition(3), ["a", "b", "c"], "y", SETTINGS, probability=probability)
    base = np.log(y.mean() / (1 - y.mean())) if probability else y.mean()
    margin = np.full(300, base)
    for _ in range(3):
        p = 1 / (1 + np.exp(-margin)) if probability else margin
        margin = margin + 0.5 * plain_tree(X, p - y, p * (1 - p) if probability else np.ones(300), 2)
    want = 1 / (1 + np.exp(-margin)) if probability else margin
    got = np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_cut_points(spark):
    df = spark.range(2000).select((F.col("id") % 5).alias("few"), (F.col("id") * 1.5).alias("many"), F.lit(3.0).alias("one"), (F.col("id") % 2 - 0.5).alias("two"))
    cuts = trees.cut_points(df, ["few", "many", "one", "two"], bins=50)
    assert cuts["few"] == [0, 1, 2, 3] and cuts["one"] == [] and cuts["two"] == [-0.5]
    assert len(cuts["many"]) == 49 and cuts["many"] == sorted(set(cuts["many"]))


def test_sampling_is_repeatable_and_constant_inputs_give_the_mean(spark):
    df = table(spark).na.fill(0.0).withColumn("one", F.lit(1.0)).coalesce(2)
    settings = trees.TreeSettings(trees=2, depth=2, rows=0.7, inputs=0.5)
    first, second = (trees.fit_trees(df, ["x", "z"], "y", settings, probability=True).trees for _ in range(2))
    assert first == second and first != trees.fit_trees(df, ["x", "z"], "y", trees.TreeSettings(trees=2, depth=2), probability=True).trees
    flat = trees.fit_trees(df, ["one"], "target", SETTINGS, probability=False)
    mean = df.agg(F.avg("target")).first()[0]
    assert all(abs(r.prediction - mean) < 1e-9 for r in flat.transform(df).limit(5).collect())
    with pytest.raises(ValueError, match="both labels"):
        trees.fit_trees(df.withColumn("y", F.lit(1)), ["x"], "y", SETTINGS, probability=True)


def test_model_type_and_learner(spark, tmp_path):
    df = table(spark).withColumn("y", (F.col("z") > 0).cast("int"))
    small = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "subsample": 1.0, "colsample_bytree": 1.0}
    model = M.fit_click_model(df, FEATURES, "y", model_type="histogram_trees", params=small)
    means = {r.y: r.m for r in M.with_prediction(model, df, "p").groupBy("y").agg(F.avg("p").alias("m")).collect()}
    assert means[1] > 0.7 > 0.3 > means[0]
    model.write().save(f"{tmp_path}/m")
    again = M.with_prediction(PipelineModel.load(f"{tmp_path}/m"), df, "p").orderBy("id").collect()
    assert [r.p for r in again] == [r.p for r in M.with_prediction(model, df, "p").orderBy("id").collect()]
    spec = M.UpliftSpec(treatment_col="t", outcome_col="y", features=FEATURES, learner="histogram_trees", learner_params={**small, "n_estimators": 1})
    scored = M.with_uplift_scores(df, M.fit_uplift(df, spec), spec)
    assert scored.filter("doubly_robust_score is null or propensity_score not between 0.05 and 0.95").isEmpty()
