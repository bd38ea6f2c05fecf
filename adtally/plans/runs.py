"""Run bookkeeping: every run appends one row to a runs table, and its reports carry the run id."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = 1

RUNS_SCHEMA = (
    "schema_version int, run_id string, run_name string, pipeline_name string, created_at timestamp, "
    "dataset string, train_rows long, validation_rows long, test_rows long, "
    "metrics map<string, double>, metadata map<string, string>"
)


def new_run_id(run_name: str | None = None) -> str:
    return f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}_{run_name or 'run'}"


def metrics_of(report: DataFrame) -> dict[str, float]:
    """The numeric columns of a one-row report."""
    row = report.first()
    return {} if row is None else {k: float(v) for k, v in row.asDict().items() if isinstance(v, int | float)}


def append_run(
    spark: SparkSession,
    folder: str,
    *,
    run_id: str,
    run_name: str,
    pipeline_name: str,
    dataset: str,
    metrics: Mapping[str, float],
    train_rows: int | None = None,
    validation_rows: int | None = None,
    test_rows: int | None = None,
    metadata: Mapping[str, str] | None = None,
) -> None:
    row = (
        SCHEMA_VERSION, run_id, run_name, pipeline_name, datetime.now(timezone.utc), dataset,
        train_rows, validation_rows, test_rows, dict(metrics), dict(metadata or {}),
    )
    spark.createDataFrame([row], RUNS_SCHEMA).write.mode("append").parquet(f"{folder}/runs")


def append_report(report: DataFrame, folder: str, name: str, run_id: str) -> None:
    report.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(f"{folder}/{name}")


def read_report(spark: SparkSession, folder: str, name: str, run_id: str) -> DataFrame:
    """A stored report of one run."""
    return spark.read.parquet(f"{folder}/{name}").filter(F.col("run_id") == run_id).drop("run_id")
