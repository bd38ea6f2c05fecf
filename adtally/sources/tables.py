"""Table sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.operators.contracts import check_source
from adtally.operators.selection import Ordering, rank_cuts

# Column types of a delimited ad log.
LOG_SCHEMA = T.StructType(
    [
        *[T.StructField(name, T.LongType()) for name in ("timestamp", "uid", "campaign", "click")],
        *[T.StructField(name, T.DoubleType()) for name in ("cost", "cpo")],
        T.StructField("time_since_last_click", T.LongType()),
        *[T.StructField(f"cat{i}", T.LongType()) for i in range(1, 10)],
        *[T.StructField(name, T.LongType()) for name in ("conversion", "click_pos", "click_nb")],
    ]
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _delimited(spark: SparkSession, path: str, separator: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("sep", separator).option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    # Columns are matched by name: the file may order them differently or hold more.
    types = {field.name: field for field in schema.fields}
    fields = [types.get(name, T.StructField(name, T.StringType())) for name in header]
    return reader.schema(T.StructType(fields)).csv(path)


def _is_gzip(path: str) -> bool:
    return path.endswith(".gz")


def read_delimited(
    spark: SparkSession,
    path: str,
    *,
    separator: str = "\t",
    schema: T.StructType | None = None,
    rows: int | None = None,
) -> DataFrame:
    """A delimited table with a header row, plain or gzip; with `rows`, only the first ones in file order.

    A gzip file is one unsplittable stream, so its rows are spread over the cluster right after the read.
    Give a schema for large files: without one the types are inferred by an extra pass.
    """
    table = _delimited(spark, path, separator, schema)
    if rows is not None:
        table = _first_in_files(table, rows, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    if _is_gzip(path):
        return table.repartition(spark.sparkContext.defaultParallelism)
    return table


def read_table(
    spark: SparkSession, path: str, *, schema: T.StructType | None = None, rows: int | None = None
) -> DataFrame:
    """Read by suffix: .parquet; .tsv and anything .gz by tab; .csv by comma. `rows` keeps the first ones."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if name.endswith(".parquet"):
        table = read_parquet(spark, path)
        return table if rows is None else head_rows(table, rows)
    if not name.endswith((".gz", ".tsv", ".csv")):
        raise ValueError(f"Unsupported tabular source format: {path}")
    separator = "\t" if ".tsv" in name or _is_gzip(name) else ","
    return read_delimited(spark, path, separator=separator, schema=schema, rows=rows)


def _first_in_files(df: DataFrame, n: int, block: Column, index: Column) -> DataFrame:
    """The first n rows by file path, block and position in it, as a filter: no rows are moved.

    Files are counted in path order, four times as many each time, until they hold n rows; no later file is opened.
    """
    everything = df.select(
        "*", F.col("_metadata.file_path").alias("__in_file"), block.alias("__in_block"), index.alias("__in_place")
    )
    # Local paths are listed with three slashes, but rows carry one.
    files, taken = sorted(name.replace("file:///", "file:/", 1) for name in df.inputFiles()), 1
    while True:
        # A plain condition on the path, which prunes files before they are read.
        placed = everything.filter(F.col("__in_file") <= files[taken - 1]) if taken < len(files) else everything
        # One row per file block.
        sizes = placed.groupBy("__in_file", "__in_block").agg(
            F.count(F.lit(1)).alias("rows"), F.min("__in_place").alias("start")
        )
        if taken >= len(files) or (sizes.agg(F.sum("rows")).first()[0] or 0) >= max(n, 1):
            break
        taken *= 4
    earlier = Window.partitionBy(F.lit(0)).orderBy("__in_file", "__in_block").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        sizes.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .filter(F.col("before") + F.col("rows") >= n)
        .orderBy("__in_file", "__in_block")
        .first()
    )
    if cut is None:
        return df
    same_file = F.col("__in_file") == cut["__in_file"]
    inside = (F.col("__in_block") == cut["__in_block"]) & (F.col("__in_place") - cut["start"] < n - cut["before"])
    earlier_block = F.col("__in_block") < cut["__in_block"]
    wanted = (F.col("__in_file") < cut["__in_file"]) | (same_file & (earlier_block | inside))
    return placed.filter(F.col("__in_file") <= cut["__in_file"]).filter(wanted).select(*df.columns)


def head_rows(df: DataFrame, n: int, *, order: list[Column] | None = None) -> DataFrame:
    """The first n rows of a parquet table in file order, or of any table by the given keys."""
    if order is not None:
        return df.filter(rank_cuts(df, [Ordering(order, [n])])[0][n])
    return _first_in_files(df, n, F.lit(0), F.col("_metadata.row_index"))


def build_head_sample(spark: SparkSession, source: str, target: str, *, rows: int = 1_000_000) -> tuple[int, int]:
    """Cut the first rows of a table, check them, write them; returns (rows, columns)."""
    sample = read_table(spark, source, rows=rows)
    check_source(sample)
    write_parquet(sample, target)
    return read_parquet(spark, target).count(), len(sample.columns)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row, nulls kept as null."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("sep", "\t").csv(path)


def read_json(spark: SparkSession, path: str, *, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per row. Without a schema the types are inferred by an extra pass."""
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)
