"""Whitening of embeddings by principal components, with eigenvectors refined beyond single precision.

Entries become whole numbers, floor(scale * c), so that sums and distances are exact. Counts, sums and the
covariance are aggregates over the distinct vectors: every task sends one partial matrix. The driver holds that
matrix (dimensions squared) and no vector. Its eigenvectors start in float32 and are corrected by the
matrix-multiplication iteration of Ogita and Aishima in extended precision: each step measures how far the
vectors are from orthonormal (R) and the matrix from diagonal (S), and adds the first-order correction. Eigenvalues too close
for their order to be told at the present error form a cluster; the matrix is shifted and projected onto the
cluster's vectors, and that small problem is solved and refined by itself.

Defined results: rows whose vector is null, empty, of another length than the most frequent one (the larger
of equally frequent lengths), or holds null or non-finite entries take no part. Entries beyond the range of a
long stand at its end. Repeated rows and null ids are kept as they are; equal vectors count once in the fit.
Components whose eigenvalue is not above `dimensions * 1e-15` of the trace do not exist, so a table with one
distinct vector, like an empty one, gives no rows. `deviation` is a decimal of 38 digits, null beyond them.
Only the two named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.sources.staging import release, stage

HIGH = np.longdouble
ROUNDS = 30
DIGITS_38 = 10**38
LEAST_SHARE = 1e-15


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors, as columns, of a symmetric matrix in extended precision."""
    a = matrix.astype(HIGH)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(len(a), HIGH), np.eye(len(a), dtype=HIGH)
    _, start = np.linalg.eigh((a / size).astype(np.float32))
    values, vectors = _refined(a / size, start.astype(HIGH))
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    # One sign for all readers: the largest entry of a vector is positive.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(a))])
    return values[order] * size, vectors * signs


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(a)
    one = np.eye(n, dtype=HIGH)
    least = n * np.finfo(HIGH).eps
    norm = np.sqrt((a * a).sum())
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        error = max(error, least * norm)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > error
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        np.fill_diagonal(step, np.diag(r) / 2)
        x = x + x @ step
        for members in _clusters(values, error):
            x[:, members] = _solve_cluster(a, x[:, members])
        if np.abs(step).max() <= least:
            break
    x = x / np.sqrt((x * x).sum(axis=0))
    return np.diag(x.T @ (a @ x)).copy(), x


def _clusters(values: np.ndarray, error: float) -> list[np.ndarray]:
    """Groups of two or more positions whose sorted values follow each other within `error`."""
    order = np.argsort(values)
    ends = np.flatnonzero(np.diff(values[order]) > error) + 1
    return [group for group in np.split(order, ends) if len(group) > 1]


def _solve_cluster(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The vectors of one cluster, turned so that they diagonalise the shifted matrix on their span."""
    x = _orthonormal(_orthonormal(x))
    inner = x.T @ (a @ x)
    inner = (inner + inner.T) / 2
    inner -= np.eye(len(inner), dtype=HIGH) * np.diag(inner).mean()
    size = np.abs(inner).max()
    if not size:
        return x
    _, turn = np.linalg.eigh((inner / size).astype(np.float64))
    return _orthonormal(x @ turn.astype(HIGH))


def _orthonormal(x: np.ndarray) -> np.ndarray:
    return x + x @ (np.eye(x.shape[1], dtype=HIGH) - x.T @ x) / 2


@dataclass(frozen=True)
class Whitening:
    """n and exact sums of the distinct vectors, the leading components and what they explain."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray  # one column per component
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return _mean(self.n, self.sums)

    def project(self, rows: np.ndarray) -> np.ndarray:
        return _project(rows, self.mean, self.vectors, self.values)


def _mean(n: int, sums: tuple[int, ...]) -> np.ndarray:
    return np.array([s / n for s in sums])


def _project(rows: np.ndarray, mean: np.ndarray, vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (rows - mean) @ vectors / np.sqrt(values)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def whole_vectors(df: DataFrame, vector_col: str, *, scale: float = 256.0) -> tuple[DataFrame, Column, int]:
    """The usable rows, the expression of their whole-number vector, and the number of dimensions (0: no row)."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = df.filter(vector.isNotNull() & (F.size(vector) > 0) & finite)
    lengths = usable.groupBy(F.size(vector).alias("length")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if top is None:
        return usable, vector, 0
    whole = F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    return usable.filter(F.size(vector) == top["length"]), whole, top["length"]


def _summed(partials: DataFrame, *keys: str) -> DataFrame:
    return partials.groupBy(*keys).agg(F.sum("part").alias("part"))


def _totals(fit: DataFrame, size: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and their exact sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for batch in batches:
            rows = _matrix(batch.column(0), size)
            n += len(rows)
            # Two halves of each number, so that no sum of a batch leaves 64 bits.
            high, low = (rows >> 32).sum(axis=0).tolist(), (rows & 0xFFFFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 32) + l for s, h, l in zip(sums, high, low, strict=True)]
        if n:
            parts = pa.array([Decimal(v) for v in [n, *sums]], type=pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), parts], ["place", "part"])

    found = {row["place"]: int(row["part"]) for row in _summed(fit.mapInArrow(run, "place int, part decimal(38,0)"), "place").collect()}
    return found.get(-1, 0), tuple(found.get(i, 0) for i in range(size))


def _second_moments(fit: DataFrame, size: int, width: int, make) -> np.ndarray:
    """Sum over all vectors of the outer products of `make(vectors)`, whose rows have `width` entries."""
    first, second = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for batch in batches:
            made = make(_matrix(batch.column(0), size))
            total += made.T @ made
            some = some or batch.num_rows > 0
        if some:
            cells = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(total[first, second])]
            yield pa.RecordBatch.from_arrays(cells, ["i", "j", "part"])

    total = np.zeros((width, width))
    for row in _summed(fit.mapInArrow(run, "i int, j int, part double"), "i", "j").toLocalIterator():
        total[row["i"], row["j"]] = total[row["j"], row["i"]] = row["part"]
    return total


def fit_whitening(fit: DataFrame, size: int, *, components: int) -> Whitening | None:
    """Fit on a table of one `x` column holding every distinct vector once; None without any component."""
    n, sums = _totals(fit, size)
    if not n:
        return None
    mean = _mean(n, sums)
    covariance = _second_moments(fit, size, size, lambda rows: rows - mean) / n
    values, vectors = (part.astype(np.float64) for part in eigenvectors(covariance))
    trace = float(np.trace(covariance))
    kept = int((values[:components] > size * LEAST_SHARE * trace).sum())
    if not kept:
        return None
    values, vectors = values[:kept], vectors[:, :kept]

    def whitened(rows: np.ndarray) -> np.ndarray:
        return np.column_stack([_project(rows, mean, vectors, values), np.ones(len(rows))])

    # The last row holds the sums of the whitened entries: what centring leaves is taken off too.
    moments = _second_moments(fit, size, kept + 1, whitened) / n
    left = moments[:kept, kept]
    identity_error = float(np.abs(moments[:kept, :kept] - np.outer(left, left) - np.eye(kept)).max())
    return Whitening(n, sums, values, vectors, trace, identity_error)


def _deviations(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """Per row the exact sum over dimensions of (n * x - S)^2."""
    most = n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums))
    if most * most * len(sums) < 2**63:
        apart = rows * np.int64(n) - np.array(sums, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    apart = rows.astype(object) * n - np.array(sums, dtype=object)
    found = (apart * apart).sum(axis=1)
    return pa.array([Decimal(v) if v < DIGITS_38 else None for v in found], type=pa.decimal128(38, 0))


def whiten(
    df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: float = 256.0
) -> DataFrame:
    """Per usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    usable, whole, size = whole_vectors(df.select(id_col, vector_col), vector_col, scale=scale)
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"key {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = None
    if size:
        fit = stage(usable.select(whole.alias("x")).distinct(), "distinct")
        model = fit_whitening(fit, size, components=components)
        release(fit)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", id_col)
    kept, explained = len(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1), size)
            each = pa.array(np.repeat(np.arange(len(rows)), kept))
            made = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * kept, model.n, dtype=np.int64)),
                _deviations(rows, model.n, model.sums).take(each),
                pa.array(model.project(rows).ravel()),
                pa.array(np.tile(explained, len(rows))),
                pa.array(np.full(len(rows) * kept, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(made, ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.select(id_col, whole.alias("x")).mapInArrow(run, schema).withColumnRenamed("key", id_col)
