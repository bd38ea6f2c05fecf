"""Approximate nearest neighbours by inner product on randomly rotated one-bit codes.

Each vector is taken relative to its nearest centroid, scaled to length one, rotated at random and cut to one
bit per component. The packed bits, the length of the difference and the product of the code with what it
stands for give an unbiased estimate of any inner product and a bound on its error. A search estimates all
products of a block of queries with the codes of a task, takes the best estimates to find a first cut, then
works out the exact product of every vector whose upper bound reaches the best cut so far.

Centroids are fitted on about `sample` vectors, chosen by a hash of their id; every vector is coded. Queries
are read in blocks of about `block` rows, so the driver and a broadcast hold at most a block, and each block
scans the written codes.

Defined results: null ids, and vectors that are null, zero, of another length than the first coded one by
count, or that hold null or non-finite components take no part, neither as query nor as candidate. A query's
own id is no candidate. Of equal products the smaller id comes first; with fewer candidates all are given.
Repeated rows are candidates and queries each. An empty table gives an empty table, and only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import uniform
from adtally.sources.staging import stage

CENTROIDS = 64
SAMPLE = 16_384
BLOCK = 4096
ERRORS = 3.0  # how many standard errors the bound allows
QUERY_ROWS = 256  # queries compared with a batch of codes at once


@dataclass
class Index:
    codes: DataFrame  # vec_id, vector, centroid, length, aligned, bits
    centroids: np.ndarray
    rotation: np.ndarray


def _usable(vector: Column, size: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def fit_centroids(sample: np.ndarray, number: int, *, rounds: int = 10, seed: int = 23) -> np.ndarray:
    """Plain k-means; a centroid that loses its vectors stays where it is."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:number]].copy()
    for _ in range(rounds):
        own = nearest_centroid(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        counts = np.bincount(own, minlength=len(centroids))
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def nearest_centroid(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * vectors @ centroids.T, axis=1)


def code(vectors: np.ndarray, centroids: np.ndarray, rotation: np.ndarray):
    """Centroid, length, alignment of the code with what it stands for, and packed bits of each vector."""
    own = nearest_centroid(vectors, centroids)
    rest = vectors - centroids[own]
    length = np.linalg.norm(rest, axis=1)
    turned = (rest @ rotation.T) / np.where(length > 0, length, 1)[:, None]
    aligned = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return own, length, np.where(length > 0, aligned, 1.0), np.packbits(turned > 0, axis=1)


def build_index(
    df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS,
    sample: int = SAMPLE, seed: int = 23,
) -> Index | None:
    """Codes of every usable vector, written to the shared folder; None if there is no usable vector."""
    given = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    given = given.filter("vec_id is not null and vector is not null")
    sizes = given.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        return None
    usable = given.filter(_usable(F.col("vector"), common["size"]))
    drawn = usable.filter(uniform(seed, F.col("vec_id")) < sample / common["n"]).orderBy("vec_id").limit(2 * sample).collect()
    drawn = drawn or usable.limit(1).collect()
    if not drawn:
        return None
    learned = np.array([r["vector"] for r in drawn], dtype=np.float64)
    centres = fit_centroids(learned, max(1, min(centroids, len(learned) // 16)), seed=seed)
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(common["size"],) * 2))[0]
    shared = df.sparkSession.sparkContext.broadcast((centres, rotation))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, length, aligned, bits = code(_matrix(batch.column(1), common["size"]), *shared.value)
            made = [pa.array(own, pa.int32()), pa.array(length), pa.array(aligned), pa.array([b.tobytes() for b in bits], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], ["vec_id", "vector", "centroid", "length", "aligned", "bits"])

    schema = "vec_id long, vector array<double>, centroid int, length double, aligned double, bits binary"
    return Index(stage(usable.mapInArrow(run, schema), "codes"), centres, rotation)


class Best:
    """The best products found so far for each query of a block, nearest first, ties to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched, number = np.unique(query, return_inverse=True)
        rows = np.concatenate([np.repeat(np.arange(len(touched)), self.k), number])
        all_ids = np.concatenate([self.ids[touched].ravel(), ids])
        all_scores = np.concatenate([self.scores[touched].ravel(), scores])
        order = np.lexsort((all_ids, -all_scores, rows))
        starts = np.searchsorted(rows[order], np.arange(len(touched)))
        chosen = order[starts[:, None] + np.arange(self.k)]
        self.ids[touched], self.scores[touched] = all_ids[chosen], all_scores[chosen]


def search_batch(
    best: Best, queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes, index, errors: float
) -> None:
    """Update `best` with one batch of coded vectors."""
    own, length, aligned, bits = codes
    centroids, rotation = index
    size = vectors.shape[1]
    signs = (np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    scale = (length / aligned).astype(np.float32)
    slack = (errors * length * np.sqrt(np.maximum(1 / aligned**2 - 1, 0)) / np.sqrt(max(size - 1, 1)) + 1e-6).astype(np.float32)
    for start in range(0, len(queries), QUERY_ROWS):
        part = slice(start, start + QUERY_ROWS)
        q = queries[part]
        estimate = ((q @ rotation.T).astype(np.float32) @ signs.T) * scale
        estimate += (q @ centroids.T).astype(np.float32)[:, own]
        same = query_ids[part][:, None] == ids[None, :]
        estimate[same] = -np.inf
        first = min(2 * best.k, estimate.shape[1])
        lead = np.argpartition(-estimate, first - 1, axis=1)[:, :first]
        exact = np.einsum("qd,qcd->qc", q, vectors[lead])
        exact[np.take_along_axis(same, lead, axis=1)] = -np.inf
        cut = best.scores[part, -1]
        if first >= best.k:
            cut = np.maximum(cut, -np.partition(-exact, best.k - 1, axis=1)[:, best.k - 1])
        norm = np.linalg.norm(q, axis=1).astype(np.float32)
        upper = estimate + norm[:, None] * slack
        which, row = np.nonzero((upper >= cut[:, None] - 1e-6) & ~same)
        for at in range(0, len(which), 500_000):
            w, r = which[at : at + 500_000], row[at : at + 500_000]
            scores = np.einsum("ij,ij->i", q[w], vectors[r])
            keep = scores >= best.scores[start + w, -1]
            if keep.any():
                best.add(start + w[keep], ids[r[keep]], scores[keep])


def _scan(shared, number: int, size: int, k: int, errors: float):
    """What a task does with its codes: the best of each query of block `number` among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, fitted = shared.value
        best = Best(len(ids), k)
        for batch in batches:
            if not len(ids) or not batch.num_rows:
                continue
            numbers, own, length, aligned = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            bits = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            coded = (own, length, aligned, bits)
            search_batch(best, vectors, ids, numbers, _matrix(batch.column(1), size), coded, fitted, errors)
        which, place = np.nonzero(np.isfinite(best.scores))
        made = [which + (number << 32), ids[which], best.ids[which, place], best.scores[which, place]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["asked", "query_id", "vec_id", "score"])

    return run


def search(index: Index, queries: Column, *, k: int = 20, block: int = BLOCK, errors: float = ERRORS) -> DataFrame:
    """The `k` nearest of every coded vector for which `queries` holds: query_id, rank, vec_id, score."""
    size = index.rotation.shape[0]
    asked = index.codes.filter(queries).select("vec_id", "vector")
    blocks = max(1, -(-asked.count() // block))
    parts = []
    for number in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).collect()
        ids = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        vectors = np.array([r["vector"] for r in rows], dtype=np.float64).reshape(-1, size)
        # About `block` vectors, the centroids and the rotation.
        shared = index.codes.sparkSession.sparkContext.broadcast((ids, vectors, (index.centroids, index.rotation)))
        schema = "asked long, query_id long, vec_id long, score double"
        parts.append(index.codes.mapInArrow(_scan(shared, number, size, k, errors), schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
