import gzip

import pytest
from pyspark.sql import functions as F

from adtally.operators.profile import describe_numeric, table_profile
from adtally.sources import tables as S
from adtally.sources.staging import shared_folder, stage


def text(rows, sep):
    return "\n".join(sep.join(str(v) for v in row) for row in [("uid", "cost"), *rows]) + "\n"


ROWS = [(i, i / 2) for i in range(50)]


def test_readers_by_suffix(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(text(ROWS, "\t"))
    (tmp_path / "a.csv").write_text(text(ROWS, ","))
    for name in ("a.tsv.gz", "a.csv.gz"):
        # any .gz is read by tab
        with gzip.open(tmp_path / name, "wt") as out:
            out.write(text(ROWS, "\t"))
    for name in ("a.tsv", "a.csv", "a.tsv.gz", "a.csv.gz"):
        df = S.read_table(spark, f"{tmp_path}/{name}", schema=S.LOG_SCHEMA)
        assert df.dtypes == [("uid", "bigint"), ("cost", "double")]
        assert sorted(tuple(r) for r in df.collect()) == ROWS
        head = S.read_table(spark, f"{tmp_path}/{name}", rows=7)
        assert sorted(r.uid for r in head.collect()) == list(range(7))
    with pytest.raises(ValueError, match="Unsupported tabular source format"):
        S.read_table(spark, f"{tmp_path}/a.json")


def test_head_spans_files(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(100).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    for n in (0, 1, 30, 77, 100, 500):
        assert sorted(r.id for r in S.read_table(spark, path, rows=n).collect()) == list(range(min(n, 100)))


def test_head_spans_text_blocks(spark, tmp_path):
    (tmp_path / "b.tsv").write_text(text([(i, 1.0) for i in range(5000)], "\t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = S.read_table(spark, f"{tmp_path}/b.tsv", schema=S.LOG_SCHEMA, rows=3210)
        assert df.rdd.getNumPartitions() > 1
        assert sorted(r.uid for r in df.collect()) == list(range(3210))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sample_and_sinks(spark, log, tmp_path):
    S.write_parquet(log.coalesce(2), f"{tmp_path}/log.parquet")
    rows, columns = S.build_head_sample(spark, f"{tmp_path}/log.parquet", f"{tmp_path}/sample", rows=100)
    assert (rows, columns) == (100, len(log.columns))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        S.write_parquet(log, f"{tmp_path}/sample")
    report = spark.createDataFrame([(1, None)], "a int, b double")
    S.write_json(report, f"{tmp_path}/json")
    S.write_csv(report, f"{tmp_path}/csv")
    assert spark.read.text(f"{tmp_path}/json").first()[0] == '{"a":1,"b":null}'
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["a", "b"]


def test_stage_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = shared_folder(spark)
    assert not configured or folder.startswith(configured)
    table = stage(spark.range(5).withColumn("x", F.lit(1)))
    assert table.count() == 5 and table.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(folder.lstrip("/"))


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (2, 8.0), (3, 9.0)], "c long, v double")
    for approximate in (False, True):
        rows = table_profile(df, mean_columns=["v"], distinct_columns=["c"], approximate=approximate).collect()
        assert {(r.measure, r.column): r.value for r in rows} == {
            ("rows", "*"): 4.0, ("columns", "*"): 2.0, ("null_rate", "c"): 0.0, ("null_rate", "v"): 0.25,
            ("mean", "v"): 7.0, ("distinct", "c"): 3.0,
        }
    row = describe_numeric(df, ["v"]).first()
    assert (row["count"], row["mean"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (3, 7.0, 4.0, 6.0, 8.0, 8.5, 9.0)
