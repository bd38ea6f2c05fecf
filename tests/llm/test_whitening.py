from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import whitening
from adtally.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)


def turned(values, seed):
    """A symmetric matrix with the given eigenvalues, and its eigenvectors, in extended precision."""
    x = np.random.default_rng(seed).standard_normal((len(values), len(values))).astype(np.longdouble)
    q = np.zeros_like(x)
    for i in range(len(values)):
        v = x[:, i]
        for _ in range(3):
            v = v - q[:, :i] @ (q[:, :i].T @ v)
        q[:, i] = v / np.sqrt(v @ v)
    return (q * np.asarray(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values",
    [
        [9.0, 7.0, 4.0, 2.0, 1.0],
        [1.0, 1.0 - 1e-9, 0.5, 0.5 - 1e-8, 0.5 - 3e-8, 0.1],
        [1e6, 1e6 - 1e-3, 3.0, 3.0 - 1e-7, 1e-6, 1e-9],
        list(2.0 + 1e-7 * np.arange(40)[::-1]),
    ],
)
def test_refined_eigenvectors_tell_close_values_apart(values):
    matrix, q = turned(values, 5)
    found, vectors = whitening.eigenvectors(matrix)
    size = max(values)
    assert np.abs(found - values).max() <= 1e-16 * size
    for i, value in enumerate(values):
        gap = min(abs(value - other) for j, other in enumerate(values) if j != i)
        angle = 1 - abs(vectors[:, i] @ q[:, i])
        assert np.sqrt(max(0.0, 2 * float(angle))) <= 1e-17 * size / gap + 1e-9


def test_equal_eigenvalues_give_an_orthonormal_basis():
    matrix, _ = turned([2.0, 2.0, 2.0, 1.0, 1.0, 0.0], 6)
    found, vectors = whitening.eigenvectors(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-16
    assert np.array_equal(whitening.eigenvectors(np.zeros((3, 3)))[1], np.eye(3))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_numpy(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = op11_whitening(spark, folder).toPandas()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    good = table[[v is not None and np.isfinite(np.asarray(v, float)).all() for v in table.embedding]]
    x = np.floor(256 * np.array([np.asarray(v, np.float64) for v in good.embedding])).astype(int)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    want = {i: k for k, i in enumerate(good.vec_id)}
    assert len(got) == 4 * len(good) and set(got.n) == {n} and set(got.component) == {1, 2, 3, 4}
    for component, part in got.groupby("component"):
        at = [want[i] for i in part.vec_id]
        assert (part.deviation.to_numpy() == ((n * x - sums) ** 2).sum(axis=1)[at]).all()
        line = (x - sums / n)[at] @ vectors[:, -component] / math.sqrt(values[-component])
        made = part.whitened.to_numpy()
        assert min(np.abs(made - line).max(), np.abs(made + line).max()) < 1e-9
        assert np.allclose(part.explained, values[-component] / values.sum(), rtol=1e-9)
    assert 0 <= got.identity_error.iloc[0] < 1e-9 and got.identity_error.nunique() == 1


def test_unusable_rows_repeats_ids_and_extra_columns(spark):
    good = [[0.5, 1.0], [2.0, -1.0], [2.0, -1.0], [-3.0, 0.25]]
    bad = [None, [], [1.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    df = rows_of(spark, good + bad)
    df = df.union(spark.createDataFrame([(None, [0.5, 1.0], 0), (0, [0.5, 1.0], 0)], SCHEMA))
    df = df.withColumns({name: F.lit("x") for name in ("x", "key", "n", "component", "part", "whitened", "place")})
    got = whitening.whiten(df).toPandas()
    assert sorted(got.vec_id.fillna(-1).tolist()) == sorted([0, 1, 2, 3, -1, 0] * 2)
    assert set(got.n) == {3} and set(got.component) == {1, 2}
    assert abs(got[got.component == 1].explained.iloc[0] + got[got.component == 2].explained.iloc[0] - 1) < 1e-12
    same = got[(got.vec_id != 1) & (got.vec_id != 2) & (got.vec_id != 3) & (got.component == 1)].whitened
    assert same.nunique() == 1


def test_tables_without_components(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(rows_of(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(rows_of(spark, [None, []])).count() == 0


def test_deviations_are_exact_beyond_64_bits(spark):
    vectors = [[1e9, 0.0], [-3e9, 1.0], [2e9, 7.0]]
    got = {(r.vec_id, r.component): int(r.deviation) for r in whitening.whiten(rows_of(spark, vectors)).collect()}
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    sums = [sum(v[i] for v in x) for i in range(2)]
    want = [sum((3 * v[i] - sums[i]) ** 2 for i in range(2)) for v in x]
    assert all(got[(i, 1)] == want[i] and want[i] > 2**63 for i in range(3))
    huge = whitening.whiten(rows_of(spark, [[1e38, 0.0], [-1e38, 1.0], [0.0, 2.0]])).collect()
    assert len(huge) == 6 or len(huge) == 3
