"""Ridge and logistic fits by sufficient statistics.

One pass over the rows sums everything a step needs. A row is the sparse vector of a leading one and its features, scaled by
the root of its weight, followed by its response over that root and the root of its loss: the Gram matrix of
such vectors holds the weighted products of all features, their products with the response, and the total loss.
A row adds one number per pair of its non-zero entries, whatever the number of categories, and tasks send one
matrix each. The driver solves a system of as many unknowns as there are features, at most MAX_SLOTS. A ridge
fit is one such pass; a logistic fit is one per Newton step, some five to ten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.feature import Interaction, OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.expressions import add_all
from adtally.sources.staging import release, stage

# Unknowns of the dense solve; its matrix has 8 * MAX_SLOTS^2 bytes. Wider fits are iterative (`models.py`).
MAX_SLOTS = 1_000
TOLERANCE = 1e-12
LEAST_WEIGHT = 1e-200


@dataclass(frozen=True)
class Layout:
    """Numeric columns, then the codes 0 .. size-1 of every code column; a code of `size` or more is unknown."""

    numeric: Sequence[str]
    codes: Sequence[str]
    sizes: Sequence[int]

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.sizes)

    def offsets(self) -> list[int]:
        return [len(self.numeric) + sum(self.sizes[:i]) for i in range(len(self.sizes))]


def linear_sum(layout: Layout, intercept: float, coefficients: Sequence[float]) -> Column:
    """intercept + the coefficients' sum over a row's features."""
    parts = [F.lit(float(intercept))]
    parts += [F.lit(float(coefficients[i])) * F.col(name) for i, name in enumerate(layout.numeric)]
    for name, size, start in zip(layout.codes, layout.sizes, layout.offsets(), strict=True):
        if size:
            own = F.lit([float(c) for c in coefficients[start : start + size]])
            parts.append(F.when(F.col(name) < size, F.get(own, F.col(name))).otherwise(0.0))
    return add_all(parts)


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


@dataclass(frozen=True)
class Moments:
    """Sums over rows, for a leading one followed by the features: weight * x x', and response * x."""

    gram: np.ndarray
    cross: np.ndarray
    loss: float


def with_vector(df: DataFrame, layout: Layout) -> DataFrame:
    """Adds the sparse vector of the features, as `vector`."""
    hot = [f"hot_{name}" for name in layout.codes]
    if hot:
        encoder = OneHotEncoder(inputCols=list(layout.codes), outputCols=hot, dropLast=True, handleInvalid="error")
        # The encoder only needs the largest code of each column, that of unknown values, which it drops: one made row.
        largest = df.sparkSession.createDataFrame([tuple(layout.sizes)], ", ".join(f"`{name}` int" for name in layout.codes))
        df = encoder.fit(largest).transform(df)
    return VectorAssembler(inputCols=[*layout.numeric, *hot], outputCol="vector").transform(df).drop(*hot)


def moments(df: DataFrame, layout: Layout, *, weight: Column, response: Column, loss: Column) -> Moments:
    """The sums of one pass over rows with a `vector`; the response is weight times what it stands for."""
    root = F.sqrt(F.greatest(weight, F.lit(LEAST_WEIGHT)))
    rows = df.select("vector", root.alias("root"), response.alias("response"), F.sqrt(loss).alias("loss"))
    rows = rows.withColumn("response", F.col("response") / F.col("root"))
    scaled = Interaction(inputCols=["root", "vector"], outputCol="scaled").transform(rows)
    whole = VectorAssembler(inputCols=["root", "scaled", "response", "loss"], outputCol="row").transform(scaled).select("row")
    sums = RowMatrix(MLUtils.convertVectorColumnsFromML(whole, "row")).computeGramianMatrix().toArray()
    size = layout.width + 1
    return Moments(sums[:size, :size], sums[:size, size], float(sums[-1, -1]))


@dataclass(frozen=True)
class Scale:
    """Numeric features as (x - mean) / spread, where the sums are well conditioned. One-hot columns stay."""

    mean: np.ndarray
    spread: np.ndarray

    @staticmethod
    def of(df: DataFrame, layout: Layout) -> Scale:
        wanted = [f(name).alias(f"{k}{i}") for i, name in enumerate(layout.numeric) for k, f in (("m", F.avg), ("s", F.stddev_pop))]
        row = df.agg(*wanted).first() if wanted else {}
        mean, spread = np.zeros(layout.width), np.ones(layout.width)
        for i in range(len(layout.numeric)):
            mean[i], spread[i] = row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0
        return Scale(mean, spread)

    def apply(self, df: DataFrame, layout: Layout) -> DataFrame:
        return df.withColumns(
            {name: (F.col(name) - F.lit(float(self.mean[i]))) / F.lit(float(self.spread[i])) for i, name in enumerate(layout.numeric)}
        )

    def undo(self, scaled: np.ndarray) -> tuple[float, np.ndarray]:
        """Intercept and coefficients of the unscaled features."""
        coefficients = scaled[1:] / self.spread
        return float(scaled[0] - coefficients @ self.mean), coefficients

    def penalty(self, strength: float) -> np.ndarray:
        """The penalty of the unscaled coefficients as a diagonal; the intercept is free."""
        return np.concatenate([[0.0], strength / self.spread**2])


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least-norm solution; features that never occur in a row stay at zero."""
    used = np.abs(matrix).max(axis=1) > 0
    out = np.zeros(len(right))
    out[used] = np.linalg.lstsq(matrix[np.ix_(used, used)], right[used], rcond=None)[0]
    return out


def solve_ridge(df: DataFrame, layout: Layout, label: str, *, alpha: float) -> tuple[float, np.ndarray]:
    """Least squares with a penalty of alpha on the squared coefficients: one pass and one solve."""
    scale = Scale.of(df, layout)
    rows = with_vector(scale.apply(df, layout), layout)
    found = moments(rows, layout, weight=F.lit(1.0), response=F.col(label), loss=F.lit(0.0))
    return scale.undo(_solve(found.gram + np.diag(scale.penalty(alpha)), found.cross))


def solve_logistic(
    df: DataFrame, layout: Layout, label: str, *, penalty: float, max_iter: int = 100
) -> tuple[float, np.ndarray]:
    """Newton steps on the summed log loss plus penalty / 2 times the squared coefficients.

    A step that does not lower the objective is halved; the last step changes it by less than TOLERANCE of it.
    """
    scale = Scale.of(df, layout)
    # Every step rereads the vectors.
    rows = stage(with_vector(scale.apply(df, layout), layout), "vectors")
    ridge = scale.penalty(penalty)
    y = F.col(label)

    def at(beta: np.ndarray) -> tuple[float, Moments]:
        margin = linear_sum(layout, beta[0], beta[1:])
        scored = rows.withColumn("__margin", margin).withColumn("__p", logistic(F.col("__margin")))
        m, p = F.col("__margin"), F.col("__p")
        loss = F.greatest(m, F.lit(0.0)) - y * m + F.log1p(F.exp(-F.abs(m)))
        found = moments(scored, layout, weight=p * (F.lit(1.0) - p), response=y - p, loss=loss)
        return found.loss + 0.5 * float(ridge @ beta**2), found

    beta = np.zeros(layout.width + 1)
    objective, found = at(beta)
    for _ in range(max_iter):
        gradient = found.cross - ridge * beta
        step = _solve(found.gram + np.diag(ridge), gradient)
        if 0.5 * float(gradient @ step) <= TOLERANCE * max(1.0, objective):
            beta = beta + step
            break
        share = 1.0
        while True:
            later, found_later = at(beta + share * step)
            if later <= objective or share < 1e-6:
                break
            share /= 2
        beta, objective, found = beta + share * step, later, found_later
    release(rows)
    return scale.undo(beta)


class LinearScorer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted linear model: adds `prediction`, the probability of label 1 or the predicted value."""

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    codes = Param(Params._dummy(), "codes", "code columns", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "codes per code column", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "intercept and coefficients", TypeConverters.toListFloat)
    probability = Param(Params._dummy(), "probability", "whether the prediction is a probability", TypeConverters.toBoolean)

    def __init__(
        self, layout: Layout = Layout((), (), ()), intercept: float = 0.0, coefficients: Sequence[float] = (), probability: bool = False
    ):
        super().__init__()
        weights = [float(intercept), *map(float, coefficients)]
        self._set(numeric=list(layout.numeric), codes=list(layout.codes), sizes=list(layout.sizes), weights=weights, probability=probability)

    @property
    def layout(self) -> Layout:
        return Layout(*(self.getOrDefault(p) for p in (self.numeric, self.codes, self.sizes)))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.weights)[0]

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.weights)[1:])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = linear_sum(self.layout, self.intercept, self.getOrDefault(self.weights)[1:])
        return dataset.withColumn("prediction", logistic(margin) if self.getOrDefault(self.probability) else margin)
