import numpy as np
import pandas as pd
import pytest

from adtally.operators import calibration as C
from adtally.operators import drift as D


def column(spark, name, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def psi(r, c):
    r, c = np.clip(r, 1e-6, None), np.clip(c, 1e-6, None)
    return float(np.sum((c - r) * np.log(c / r)))


def test_numeric_drift(spark):
    reference, current = [0.1, 0.2, 0.3, 0.4], [0.2, 0.3, 0.5, 0.6]
    row = D.numeric_drift(column(spark, "s", reference), column(spark, "s", current), columns=["s"], bins=2).first()
    assert (row.kind, row.reference_rows, row.current_rows) == ("numeric", 4, 4)
    assert (row.reference_mean, row.current_mean, row.mean_delta) == pytest.approx((0.25, 0.40, 0.15))
    assert row.reference_std == pytest.approx(np.std(reference))
    assert row.psi == pytest.approx(psi([0.5, 0.5], [0.25, 0.75]))


def test_numeric_index_matches_cut(spark):
    rng = np.random.default_rng(4)
    reference = np.where(rng.random(800) < 0.35, 0.0, rng.normal(size=800))
    current = rng.normal(0.4, 1.2, size=500)
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    shares = [pd.cut(pd.Series(v), edges, include_lowest=True).value_counts(sort=False) / len(v) for v in (reference, current)]
    row = D.numeric_drift(
        column(spark, "x", reference.tolist()), column(spark, "x", current.tolist()), columns=["x"]
    ).first()
    assert row.psi == pytest.approx(psi(*[s.to_numpy() for s in shares]))


def test_numeric_edge_cases(spark):
    one = lambda ref, cur, kind="double": D.numeric_drift(
        column(spark, "x", ref, kind), column(spark, "x", cur, kind), columns=["x"]
    ).first()
    assert one([2.0, 2.0], [1.0, 5.0]).psi == 0.0
    empty = one([None, None], [1.0])
    assert empty.psi is None and empty.reference_mean is None and empty.mean_delta is None
    assert empty.reference_missing_rate == 1.0
    same = one([1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    assert same.psi == pytest.approx(0.0)
    text = one(["1", "x", "3"], ["2", None, "4"], "string")
    assert text.reference_missing_rate == pytest.approx(1 / 3) and text.current_mean == 3.0


def test_categorical_drift(spark):
    row = D.categorical_drift(
        column(spark, "campaign", [1, 1, 2, 2], "long"), column(spark, "campaign", [1, 2, 3, 3], "long"),
        columns=["campaign"], top_n=3,
    ).first()
    assert row.new_category_share == 0.5 and (row.reference_unique, row.current_unique) == (2, 3)
    assert (row.top_reference_category, row.top_current_category) == ("1", "3")
    assert row.psi == pytest.approx(psi([0.5, 0.5, 0.0], [0.25, 0.25, 0.5]))


def test_categorical_nulls_and_top_list(spark):
    reference = [None, None, None, 10, 10, 9, 8]
    current = [7, 7, 7, None, 10, 10]
    row = D.categorical_drift(
        column(spark, "c", reference, "long"), column(spark, "c", current, "long"), columns=["c"], top_n=2
    ).first()
    assert row.top_reference_category is None and row.top_current_category == "7"
    assert row.reference_missing_rate == pytest.approx(3 / 7) and row.reference_unique == 3
    assert row.new_category_share == pytest.approx(0.5)
    # top two of each side: null and 10, 7 and 10; null counts once
    assert row.psi == pytest.approx(psi([3 / 7, 2 / 7, 0], [1 / 6, 2 / 6, 3 / 6]))


def test_missing_column_is_named(spark):
    a, b = column(spark, "x", [1.0]), column(spark, "y", [1.0])
    with pytest.raises(ValueError, match="current data is missing drift column: x"):
        D.numeric_drift(a, b, columns=["x"])
    with pytest.raises(ValueError, match="reference data is missing drift column: y"):
        D.categorical_drift(a, b, columns=["y"])


def labelled(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, scores, strict=True)), "y int, s double")


def totals(spark, ref, cur, bins=2):
    return C.calibration_totals(labelled(spark, *ref), labelled(spark, *cur), label_col="y", score_col="s", bins=bins)


REF, CUR = ([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]), ([0, 1, 1, 1], [0.2, 0.5, 0.7, 0.8])


def test_calibration_drift(spark):
    row = C.calibration_drift_summary(totals(spark, REF, CUR)).first()
    assert (row.reference_rows, row.current_rows, row.bins) == (4, 4, 2)
    assert row.current_positive_rate == 0.75 and row.positive_rate_delta == 0.25
    assert row.reference_calibration_mae == pytest.approx(0.15)
    # one row-weighted error: bin 1 holds 0.2 and 0.5 with rate 0.5, bin 2 holds 0.7 and 0.8 with rate 1
    assert row.current_calibration_mae == pytest.approx((0.15 * 2 + 0.25 * 2) / 4)
    assert row.calibration_mae_delta > 0


def test_calibration_bins_keep_one_sided_bins(spark):
    bins = C.calibration_drift_bins(totals(spark, REF, ([1, 1], [0.9, 0.95]))).collect()
    assert [b.bin for b in bins] == [1, 2]
    assert (bins[0].current_rows, bins[0].current_avg_score, bins[0].current_actual_rate) == (0, 0.0, 0.0)
    assert bins[0].actual_rate_delta == 0.0 and bins[0].avg_score_delta == pytest.approx(-0.15)
    constant = C.calibration_drift_bins(totals(spark, ([0, 1], [0.4, 0.4]), CUR)).collect()
    assert len(constant) == 1 and constant[0].current_rows == 4


def test_calibration_input_errors(spark):
    with pytest.raises(ValueError, match="scores in current do not lie between 0 and 1"):
        totals(spark, REF, ([0, 1], [0.1, 1.2]))
    with pytest.raises(ValueError, match="labels other than 0 and 1 in reference"):
        totals(spark, ([0, 2], [0.1, 0.2]), CUR)
    with pytest.raises(ValueError, match="rows without label or score"):
        totals(spark, REF, ([0, None], [0.1, 0.2]))
    with pytest.raises(ValueError, match="no rows to calibrate on"):
        totals(spark, ([], []), CUR)
    with pytest.raises(ValueError, match="bins must be at least 2"):
        totals(spark, REF, CUR, bins=1)
