import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adtally.operators import evaluation as E


def frame(spark, rows=1500):
    rng = np.random.default_rng(11)
    score = np.where(rng.random(rows) < 0.35, 0.25, rng.random(rows).round(3))
    pdf = pd.DataFrame(
        {
            "g": np.where(rng.random(rows) < 0.6, 1, rng.integers(2, 5, rows)),
            "y": (rng.random(rows) < score).astype(int),
            "s": score,
            "timestamp": rng.permutation(rows),
        }
    )
    pdf.loc[pdf.g == 4, "y"] = 0
    return pdf, spark.createDataFrame(pdf).repartition(4)


def reference(pdf):
    """Pairwise area, step-wise precision, and the two error means."""
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    auc = ap = None
    if len(pos) and len(neg):
        auc = np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))
        ap = sum(
            (pos == t).sum() / len(pos) * (pos >= t).sum() / ((pos >= t).sum() + (neg >= t).sum()) for t in np.unique(pos)
        )
    p = pdf.s.clip(2.220446049250313e-16, 1 - 2.220446049250313e-16)
    loss = -(pdf.y * np.log(p) + (1 - pdf.y) * np.log(1 - p)).mean()
    return len(pdf), pdf.y.mean(), pdf.s.mean(), auc, ap, loss, ((pdf.s - pdf.y) ** 2).mean()


def check(row, pdf):
    got = (row["rows"], row.positive_rate, row.avg_score, row.roc_auc, row.pr_auc, row.log_loss, row.brier_score)
    for have, want in zip(got, reference(pdf), strict=True):
        assert have is None if want is None else have == pytest.approx(want)


@pytest.mark.parametrize("rows_per_bucket", [20, 500_000])
def test_metrics_overall_and_per_group(spark, rows_per_bucket):
    pdf, df = frame(spark)
    options = {"label_col": "y", "score_col": "s", "rows_per_bucket": rows_per_bucket}
    check(E.binary_metrics(df, **options).first(), pdf)
    rows = E.binary_metrics(df, by=["g"], **options).collect()
    assert {r.g for r in rows} == {1, 2, 3, 4}
    for row in rows:
        check(row, pdf[pdf.g == row.g])
    assert next(r for r in rows if r.g == 4).roc_auc is None


def test_bins_match_quantile_cut(spark):
    pdf, df = frame(spark)
    pdf["bin"] = pd.qcut(pdf.s, q=10, labels=False, duplicates="drop")
    want = pdf.groupby("bin").agg(rows=("y", "size"), positives=("y", "sum"), avg=("s", "mean"), rate=("y", "mean"))
    rows = E.calibration_bins(df, label_col="y", score_col="s").orderBy("bin").collect()
    assert [r.bin for r in rows] == want.index.tolist()
    assert [r["rows"] for r in rows] == want.rows.tolist()
    assert [r.positives for r in rows] == want.positives.tolist()
    assert [r.rank_by_score for r in rows] == list(range(len(rows), 0, -1))
    assert [r.lift_vs_baseline for r in rows] == pytest.approx((want.rate / pdf.y.mean()).tolist())
    summary = E.calibration_summary(E.calibration_bins(df, label_col="y", score_col="s")).first()
    assert summary.calibration_bin_mae == pytest.approx((want.avg - want.rate).abs().mean())
    assert summary.top_bin_lift == pytest.approx(want.rate.iloc[-1] / pdf.y.mean())


def test_constant_score_and_no_positives(spark):
    df = spark.createDataFrame([(0.3, 0), (0.3, 0)], "s double, y int")
    rows = E.calibration_bins(df, label_col="y", score_col="s").collect()
    assert len(rows) == 1 and rows[0].lift_vs_baseline is None
    row = E.binary_metrics(df, label_col="y", score_col="s").first()
    assert row.roc_auc is None and row.pr_auc is None and row.log_loss == pytest.approx(-np.log(0.7))


def test_certain_scores_have_finite_loss(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1)], "s double, y int")
    assert E.binary_metrics(df, label_col="y", score_col="s").first().log_loss == pytest.approx(-np.log(2.22e-16) / 2, rel=1e-3)


def test_slices(spark):
    pdf, df = frame(spark)
    df = df.withColumns({"campaign": F.when(F.col("g") != 3, F.col("g")), "uid": F.col("timestamp")})
    rows = E.campaign_slices(df, label_col="y", score_col="s", top_campaigns=2).collect()
    counts = pdf[pdf.g != 3].g.value_counts()
    assert [r["group"] for r in rows] == [str(g) for g in counts.index[:2]]
    assert [r["rows"] for r in rows] == counts.tolist()[:2]
    slices = E.time_slices(df, label_col="y", score_col="s", slices=4, order=["timestamp"]).collect()
    pdf["slice"] = pd.qcut(pdf.timestamp, 4, labels=False)
    for row in slices:
        part = pdf[pdf.slice == row.time_slice - 1]
        check(row, part)
        assert (row.timestamp_min, row.timestamp_max) == (part.timestamp.min(), part.timestamp.max())
        assert row["group"] == f"slice_{row.time_slice}"


@pytest.mark.parametrize("row, message", [((None, 0.5), "label column"), ((1, None), "score column"), ((1, float("nan")), "score column")])
def test_rows_without_label_or_score_are_refused(spark, row, message):
    df = spark.createDataFrame([(1, 0.2), (0, 0.4), row], "y int, s double")
    with pytest.raises(ValueError, match=f"1 rows have no value in the {message}"):
        E.binary_metrics(df, label_col="y", score_col="s")
