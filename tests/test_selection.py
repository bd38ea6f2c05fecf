import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtally.operators import selection
from adtally.operators.selection import Ask, Ordering, medians, quantile_edges, rank_cuts, values_at_ranks


def frame(spark, rows=5000):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "x": rng.normal(size=rows),
            # A third of all rows share one value.
            "tied": np.where(rng.random(rows) < 0.34, 0.0, np.round(rng.random(rows), 2)),
            "big": rng.integers(2**60, 2**60 + 900, size=rows),
            "id": rng.permutation(rows),
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("finish_rows", [0, 5000])
@pytest.mark.parametrize("size", [64, 2_000])
def test_values_at_ranks_are_exact(spark, monkeypatch, size, finish_rows):
    monkeypatch.setattr(selection, "SKETCH_SIZE", size)
    pdf, df = frame(spark)
    ranks = [1, 2, 17, 1234, 2500, 4999, 5000]
    asks = [Ask(F.col(name), ranks) for name in ("x", "tied", "big")]
    for name, hits in zip(("x", "tied", "big"), values_at_ranks(df, asks, finish_rows=finish_rows), strict=True):
        ordered = np.sort(pdf[name].to_numpy())
        for rank in ranks:
            hit = hits[rank]
            assert hit.value == ordered[rank - 1]
            assert hit.below == (ordered < hit.value).sum()
            assert hit.ties == (ordered == hit.value).sum()


def test_condition_nulls_and_bounds(spark):
    df = spark.createDataFrame([(i, float(i) if i % 3 else None) for i in range(1, 31)], "id long, v double")
    hits = values_at_ranks(df, [Ask(F.col("v"), [1, 10], F.col("id") > 10)])[0]
    assert (hits[1].value, hits[10].value) == (11.0, 25.0)
    with pytest.raises(ValueError, match="outside"):
        values_at_ranks(df, [Ask(F.col("v"), [21])])


def test_negative_zero_equals_zero(spark):
    df = spark.createDataFrame([(-1.0,), (-0.0,), (0.0,), (1.0,)], "v double")
    hits = values_at_ranks(df, [Ask(F.col("v"), [2, 3])])[0]
    assert hits[2] == hits[3] and hits[2].value == 0.0 and (hits[2].below, hits[2].ties) == (1, 2)


def test_cuts_split_ties_by_the_next_key(spark):
    pdf, df = frame(spark)
    keys = [F.col("tied"), F.col("id")]
    ranks = [0, 1, 300, 1000, 1699, 4000, 5000, 9000]
    want = pdf.sort_values(["tied", "id"]).id.to_numpy()
    cuts = rank_cuts(df, [Ordering(keys, ranks)])[0]
    for rank in ranks:
        assert set(df.filter(cuts[rank]).toPandas().id) == set(want[:rank])


def test_cut_between_equal_rows_is_refused(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "v double")
    assert df.filter(rank_cuts(df, [Ordering([F.col("v")], [2])])[0][2]).count() == 2
    with pytest.raises(ValueError, match="do not identify rows"):
        rank_cuts(df, [Ordering([F.col("v")], [1])])


def test_quantile_edges_equal_pandas(spark):
    pdf, df = frame(spark)
    edges = quantile_edges(df, {name: F.col(name) for name in ("x", "tied")}, bins=10)
    for name in ("x", "tied"):
        assert edges[name] == np.unique(pdf[name].quantile(np.linspace(0.0, 1.0, 11)).to_numpy()).tolist()


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantile_edges(df, {"v": F.col("v")}, bins=4) == {"v": []}
    assert medians(df, {"v": F.col("v")}) == {"v": None}


def test_median_is_the_mean_of_the_middle_two(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "v long")
    assert medians(df, {"v": F.col("v")}) == {"v": 2.5}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([-2.5, -0.0, 0.0, 1e-300, 0.1, 0.3, 7.0, 1e9]), min_size=1, max_size=40), st.data())
def test_any_sample(spark, values, data):
    rank = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    hit = values_at_ranks(df, [Ask(F.col("v"), [rank])])[0][rank]
    assert hit.value == sorted(values)[rank - 1]


def test_sketches_are_near_and_end_in_the_extremes(spark):
    df = spark.range(100_000).selectExpr("id", "CAST(NULL AS DOUBLE) AS none").repartition(30)
    found = selection.sketched_quantiles(df, {"id": (F.col("id"), [0.1, 0.5, 0.9]), "none": (F.col("none"), [0.5])})
    *middle, least, most = found["id"]
    assert (least, most) == (0, 99_999) and found["none"] == []
    assert all(abs(v / 100_000 - share) < selection.rank_error(selection.SKETCH_SIZE) for v, share in zip(middle, [0.1, 0.5, 0.9]))


def test_nan_has_no_rank(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    assert selection.medians(df, {"v": F.col("v")}) == {"v": 2.0}
    assert selection.quantiles(df, {"v": F.col("v")}, bins=2) == {"v": [1.0, 2.0, 3.0]}
