"""Category codes as a written table, and the model stages that read it.

The distinct training values of every categorical column are numbered by a distributed sort and written; rows
get their code by a join on the value. No list of categories passes the driver, so the number of categories is
open: small tables are broadcast by the planner, large ones meet the rows in a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.operators.ranking import with_row_number
from adtally.sources.staging import stage


def category_codes(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0-based code of every non-null value per column, in numeric order: (name, value, code).

    The distinct values of all columns are numbered as one range-partitioned order; a column's codes start
    at its first number.
    """
    pairs = [item for name in columns for item in (F.lit(name), F.col(name).cast("long"))]
    values = (
        rows.select(F.stack(F.lit(len(columns)), *pairs).alias("name", "value"))
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    numbered = stage(with_row_number(values, [F.asc("name"), F.asc("value")], "number"), "codes")
    first = numbered.groupBy("name").agg(F.min("number").alias("first"))
    # One row per column is broadcast.
    code = (F.col("number") - F.col("first")).alias("code")
    return numbered.join(F.broadcast(first), "name").select("name", "value", code)


def with_code(df: DataFrame, column: str, codes: DataFrame, name: str, output: str) -> DataFrame:
    """The code of `column` under `name` in the table of codes; null for values without one."""
    own = codes.filter(F.col("name") == name).select(F.col("value").alias("__coded_value"), F.col("code").alias("__code"))
    joined = df.join(own, F.col(column).cast("long") == F.col("__coded_value"), "left")
    return joined.withColumn(output, F.col("__code")).drop("__coded_value", "__code")


class CategoryCodes(Transformer, MLWritable, MLReadable):
    """Adds the code of every column as `idx_<column>`; values never trained on get the code after the last.

    `sizes` holds the number of codes per column. The table of codes is saved and loaded with the stage.
    """

    columns = Param(Params._dummy(), "columns", "columns to encode", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "number of codes per column", TypeConverters.toListInt)

    def __init__(self, columns: Sequence[str] = (), sizes: Sequence[int] = (), codes: DataFrame | None = None):
        super().__init__()
        self._set(columns=list(columns), sizes=list(sizes))
        self.codes = codes

    @classmethod
    def fit(cls, rows: DataFrame, columns: Sequence[str]) -> CategoryCodes:
        codes = stage(category_codes(rows, columns), "category-codes")
        counts = {row["name"]: row["count"] for row in codes.groupBy("name").count().collect()}
        return cls(columns, [counts.get(name, 0) for name in columns], codes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for name, size in zip(self.getOrDefault(self.columns), self.getOrDefault(self.sizes), strict=True):
            dataset = with_code(dataset, name, self.codes, name, f"idx_{name}")
            dataset = dataset.withColumn(f"idx_{name}", F.coalesce(f"idx_{name}", F.lit(size)).cast("int"))
        return dataset

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader(cls)


class _CodesWriter(MLWriter):
    def __init__(self, instance: CategoryCodes):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.codes.write.parquet(f"{path}/codes")


class _CodesReader(MLReader):
    def __init__(self, kind: type[CategoryCodes]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> CategoryCodes:
        spark = SparkSession.getActiveSession() or self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        found = self.kind()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        found.codes = spark.read.parquet(f"{path}/codes")
        return found
