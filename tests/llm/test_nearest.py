from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import nearest
from adtally.llm.queries import op2_nearest


def brute(rows, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        others = np.flatnonzero(ids != ids[i])
        order = others[np.lexsort((ids[others], -scores[others]))][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def test_query_recall_and_scores(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, got = brute(rows), {}
    for r in op2_nearest(spark, folder).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys()
    hits = 0
    vectors = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for query, expected in want.items():
        found = [got[query][i + 1] for i in range(len(expected))]
        hits += len({i for i, _ in found} & {i for i, _ in expected})
        assert all(abs(vectors[query] @ vectors[i] - s) < 1e-12 for i, s in found)
        assert all(a[1] >= b[1] for a, b in zip(found, found[1:]))
    assert hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("kind", ["clusters", "copies", "lengths"])
def test_recall_on_made_vectors(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 24))
    if kind == "clusters":
        x = x * 0.05 + rng.normal(size=(8, 24))[rng.integers(0, 8, 2000)]
    if kind == "copies":
        x[:900] = x[0]
    if kind == "lengths":
        x *= rng.lognormal(size=(2000, 1))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    index = nearest.build_index(df)
    found = nearest.search(index, F.col("vec_id") % 20 == 0, block=40).collect()
    got: dict = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert got.keys() == want.keys()
    hits = 0
    for query, expected in want.items():
        assert [g[0] for g in sorted(got[query])] == list(range(1, 21))
        hits += sum(abs(a[2] - b[1]) < 1e-9 for a, b in zip(sorted(got[query]), expected))
    assert hits >= 0.98 * 20 * len(want)
    if kind == "copies":  # ties go to the smaller id
        assert [g[1] for g in sorted(got[0])][:3] == [i for i, _ in want[0]][:3]


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [1.0, None]), (100, [inf, 0.0])]
    rows += [(None, [1.0, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [1.0]), (3, []), (4, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = nearest.search(nearest.build_index(df), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in found] == [(0, 4, 2.0), (0, 1, 0.5), (0, 1, 0.5)]
    assert nearest.build_index(df.limit(0)) is None
    assert nearest.build_index(df.filter("vec_id = 20")) is None
