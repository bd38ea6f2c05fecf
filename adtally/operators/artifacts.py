"""Saved models: versioned artefacts with a contract, and a reader that checks it.

An artefact is a folder `<name>/v<number>` with the fitted pipeline (category tables included) and a
one-row contract: format, label, what the columns are for and their types. A new save never touches an older
version. The contract is written last, so a version without one was never finished and is not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adtally.operators.models import Features

FORMAT = 1
CONTRACT = "format int, name string, version int, label string, numeric array<string>, categorical array<string>, types map<string,string>"


@dataclass(frozen=True)
class Artifact:
    model: PipelineModel
    name: str
    version: int
    label: str
    features: Features
    types: dict[str, str]


def _versions(spark: SparkSession, folder: str, *, finished: bool) -> list[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root)]
    numbers = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
    done = lambda n: files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{n}/contract/_SUCCESS"))
    return [n for n in numbers if not finished or done(n)]


def save_artifact(model: PipelineModel, folder: str, name: str, *, trained_on: DataFrame, features: Features, label: str) -> int:
    """Save as the next version and return its number."""
    spark = trained_on.sparkSession
    version = max(_versions(spark, f"{folder}/{name}", finished=False), default=0) + 1
    path = f"{folder}/{name}/v{version}"
    model.write().save(f"{path}/model")
    types = {c: trained_on.schema[c].dataType.simpleString() for c in (*features.numeric, *features.categorical)}
    row = (FORMAT, name, version, label, list(features.numeric), list(features.categorical), types)
    spark.createDataFrame([row], CONTRACT).coalesce(1).write.json(f"{path}/contract")
    return version


def load_artifact(spark: SparkSession, folder: str, name: str, version: int | None = None) -> Artifact:
    """A saved version, the latest finished one by default."""
    found = _versions(spark, f"{folder}/{name}", finished=True)
    if not found or (version is not None and version not in found):
        raise ValueError(f"no saved model {name} of version {version or 'any'} in {folder}; versions: {found}")
    version = version or found[-1]
    path = f"{folder}/{name}/v{version}"
    contract = spark.read.schema(CONTRACT).json(f"{path}/contract").first()
    if contract["format"] != FORMAT:
        raise ValueError(f"model {name} v{version} has format {contract['format']}, this reader knows {FORMAT}")
    features = Features(tuple(contract["numeric"]), tuple(contract["categorical"]))
    return Artifact(PipelineModel.load(f"{path}/model"), name, version, contract["label"], features, contract["types"])


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "whole"
    return "number" if isinstance(kind, T.NumericType) else kind.simpleString()


def check_columns(artifact: Artifact, df: DataFrame) -> None:
    """Refuse a table that lacks a feature or holds one of another kind than the model was trained on."""
    wanted = (*artifact.features.numeric, *artifact.features.categorical)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"model {artifact.name} v{artifact.version} needs columns that the table lacks: {missing}")
    whole = set(artifact.features.categorical)
    wrong = []
    for c in wanted:
        kind = _family(df.schema[c].dataType)
        # Any number serves as a numeric feature; categories are whole numbers.
        if kind not in (("whole",) if c in whole else ("whole", "number")):
            wrong.append(f"{c}: {df.schema[c].dataType.simpleString()}, trained on {artifact.types.get(c)}")
    if wrong:
        raise ValueError(f"model {artifact.name} v{artifact.version} cannot read columns of another kind: {wrong}")
