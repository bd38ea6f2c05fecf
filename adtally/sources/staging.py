"""Written intermediate tables.

A table that several jobs reread is written once to the shared folder the cluster names in
`spark.checkpoint.dir`. Later jobs then scan only the columns they need, and a lost executor costs a
reread instead of a recomputation of the whole lineage.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_caches: list[dict] = []
_scopes: list[list[str]] = []


def staged_cache() -> dict:
    """A dictionary for staged DataFrames that is emptied when their tables are deleted."""
    _caches.append({})
    return _caches[-1]


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, under `spark.checkpoint.dir`.

    Where nothing is configured, a local session gets a checkpoint folder of its own beside its warehouse.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    configured = configured or context.getCheckpointDir()
    local = context.master.startswith("local")
    if not configured and local:
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
        configured = context.getCheckpointDir()
        _remove_at_exit(configured)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if configured.startswith("file:") and not local:
        raise RuntimeError("spark.checkpoint.dir must be a folder every executor can reach, not a local one")
    return f"{configured.rstrip('/')}/adtally-{context.applicationId}"


def _remove_at_exit(folder: str) -> None:
    """A checkpoint folder that this process made goes with it."""
    path = urlparse(folder)
    if path.scheme in ("", "file"):
        atexit.register(shutil.rmtree, path.path, ignore_errors=True)


def stage(df: DataFrame, label: str = "table", *, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` as parquet in the shared folder and return the written table.

    With `partition_by`, later filters on those columns skip whole files.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    staged._staged_path = path
    return staged


def release(*staged: DataFrame) -> None:
    """Delete the tables of staged DataFrames that nothing will read again."""
    for df in staged:
        _delete(df.sparkSession, df._staged_path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the paths of the tables staged inside, for `delete_tables` once they are not needed."""
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        _scopes.pop()


def delete_tables(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; caches keep what was staged before."""
    before = [dict(cache) for cache in _caches]
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)
        for cache, kept in zip(_caches, before):
            for key in cache.keys() - kept.keys():
                del cache[key]


def drop_staged(spark: SparkSession) -> None:
    """Delete every intermediate table this application wrote. Staged DataFrames cannot be read afterwards."""
    _delete(spark, shared_folder(spark))
    for cache in _caches:
        cache.clear()
