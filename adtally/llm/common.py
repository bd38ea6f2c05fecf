"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: white space between words.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"

# Rows of one output batch are cut so that their texts stay below this many characters.
BATCH_CHARS = 1_000_000
BATCH_ROWS = 1_000  # texts held as Python strings at a time


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, modulus: int) -> Column:
    """The crc32 of a key's decimal text, modulo `modulus`: the held-out rule of the contracts."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def uniform(seed: int, *columns: str | Column) -> Column:
    """A repeatable draw in [0, 1) from a hash of the columns."""
    return (F.xxhash64(F.lit(seed), *columns).bitwiseAND((1 << 53) - 1)) / F.lit(float(1 << 53))


def chunks_by_size(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts holding about `limit` characters; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and the offset of each text with the end appended."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return points, offsets


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the splitmix finalizer)."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def give_back() -> None:
    """At the end of a task: memory that Arrow and the C library keep goes back, as the worker process waits on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_texts(
    df: DataFrame, *, keep: Sequence[str], text_col: str, outputs: dict[str, str],
    compute: Callable[[list[str]], dict[str, Sequence]], limit: int = BATCH_CHARS,
) -> DataFrame:
    """The columns of `keep`, untouched, and the outputs `compute` gives for each batch of texts (null: empty)."""
    keep = list(dict.fromkeys(keep))
    names = [*keep, *([] if text_col in keep else [text_col])]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(begin, BATCH_ROWS)
                texts = [t or "" for t in part.column(at).to_pylist()]
                for start, end in chunks_by_size(texts, limit):
                    found = compute(texts[start:end])
                    kept = [part.column(i).slice(start, end - start) for i in range(len(keep))]
                    made = [pa.array(found[name], type=ARROW[kind]) for name, kind in outputs.items()]
                    yield pa.RecordBatch.from_arrays([*kept, *made], names=[f"c{i}" for i in range(len(kept) + len(made))])
        give_back()

    kinds = [*(df.schema[name].dataType.simpleString() for name in keep), *outputs.values()]
    inner = df.select(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)])
    out = inner.mapInArrow(run, ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds)))
    return out.toDF(*keep, *outputs)
