"""Made-up rows with the awkward cases every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 977} the tail{i % 31}" for i in range(20_000))
TEXTS = [None, "", " ", "\n\t\r", "a", "A b\x0bc\x0cd", "Été ÎLE ß ÿ", "日本語 🙂 x\x1cy", "<|endoftext|>x<|startoftext|>", "it's we'LL", LONG]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[str | None], **more) -> DataFrame:
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Null keys, null columns, repeated rows, and columns named like outputs."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "the key is null", None, None, None)]
    from pyspark.sql import functions as F

    extra = {name: F.lit("x") for name in ("ids", "score", "key", "c0", "c1", "n", "words", "spans", "size")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(extra)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
