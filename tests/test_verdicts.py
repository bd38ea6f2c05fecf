import pytest
from pyspark.sql import functions as F

from adtally.operators import verdicts as V
from adtally.plans import jobs
from tests.test_contracts import source


def by(df, *names):
    return {tuple(r[n] for n in names): r["verdict"] for r in df.collect()}


def test_columns(spark):
    df = source(spark)
    assert set(by(V.column_verdicts(df), "column").values()) == {"ok"}
    broken = df.drop("cpo").withColumns({"uid": F.lit(1.0), "cost": F.col("cost").cast("int")})
    found = by(V.column_verdicts(broken), "column")
    assert found[("cpo",)] == "missing" and found[("uid",)] == "wrong type" and found[("cost",)] == "ok"
    with pytest.raises(ValueError, match="log refused: .*'column': 'cpo'"):
        V.refuse(V.column_verdicts(broken), "log")
    V.refuse(V.column_verdicts(df), "log")


def test_values_and_empty_tables(spark):
    rows = spark.createDataFrame([("train", 0, 0.5), ("train", 2, 1.5), ("test", None, float("nan"))], "split string, y int, s double")
    labels = by(V.label_verdicts(rows, label_col="y", split_col="split"), "split", "check")
    assert labels == {("train", "binary"): "not binary", ("train", "null"): "ok", ("test", "binary"): "ok", ("test", "null"): "missing"}
    found = {r["check"]: r["violations"] for r in V.calibration_verdicts(rows, label_col="y", score_col="s").collect()}
    assert found == {"rows": 0, "nulls": 1, "labels": 1, "scores": 2}
    nothing = rows.filter("y > 9")
    assert by(V.calibration_verdicts(nothing, label_col="y", score_col="s"), "check")[("rows",)] == "empty"
    assert V.label_verdicts(nothing, label_col="y", split_col="split").count() == 0
    arms = V.overlap_verdicts(rows, treatment_col="y", split_col="split")
    assert by(arms, "split") == {("train",): "no treated rows", ("test",): "no treated rows"}


def test_run_limits_and_validation_rows(spark, log, scored):
    whole = jobs.run_attribution(log)["attribution_summary"].first()["rows"]
    assert whole > 50 and jobs.run_attribution(log, max_rows=50)["attribution_summary"].first()["rows"] == 50
    summary = jobs.run_drift(scored, numeric=["log_cost"], categorical=["cat9"])["drift_summary"].first()
    assert summary["validation_rows"] == scored.filter("split = 'validation'").count()
