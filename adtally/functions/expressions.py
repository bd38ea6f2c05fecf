"""Column expressions shared by the operators. All are built-in SQL functions, no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest step of a double at 1.0 (log loss) and the floor of a share (stability index).
PROBABILITY_EPSILON = 2.220446049250313e-16
SHARE_FLOOR = 1e-6


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def correlation(first: str, second: str) -> Column:
    """Aggregate: linear correlation over rows where both are known, null when either is constant.

    Built from the covariance because the built-in correlation raises on a constant column in ANSI mode.
    """
    a = F.when(F.col(second).isNotNull(), F.col(first).cast("double"))
    b = F.when(F.col(first).isNotNull(), F.col(second).cast("double"))
    return ratio(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def clip(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low))))


def add_all(terms: Sequence[Column]) -> Column:
    """Sum of many terms as a shallow expression tree."""
    terms = list(terms)
    if not terms:
        return F.lit(0)
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def bin_index(value: Column, inner_edges: Sequence[float]) -> Column:
    """0-based right-closed bin: the number of inner edges below the value. Null stays null."""
    steps = [(value > F.lit(float(edge))).cast("int") for edge in inner_edges]
    return add_all(steps) if steps else F.when(value.isNotNull(), F.lit(0))


def descending(value: Column) -> Column:
    """An ascending sort key for 'highest first, nulls last'."""
    return F.coalesce(-value.cast("double"), F.lit(float("inf")))


def hash_uniform(seed: int, key_columns: Sequence[str], salt: str = "") -> Column:
    """A number in [0, 1) that depends on seed and row key only: equal on every retry and every layout."""
    prefix = f"{seed}|{salt}|" if salt else f"{seed}|"
    text = F.concat(F.lit(prefix), F.concat_ws("|", *[F.col(name).cast("string") for name in key_columns]))
    # 13 hex digits are 52 bits, which a double holds exactly.
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(4503599627370496.0)


def population_stability(reference_share: Column, current_share: Column) -> Column:
    """One bin's term of the population stability index."""
    reference = F.greatest(reference_share, F.lit(SHARE_FLOOR))
    current = F.greatest(current_share, F.lit(SHARE_FLOOR))
    return (current - reference) * F.ln(current / reference)


def clipped_probability(score: Column) -> Column:
    return clip(score, PROBABILITY_EPSILON, 1.0 - PROBABILITY_EPSILON)
