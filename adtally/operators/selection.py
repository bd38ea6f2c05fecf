"""Exact order statistics and rank cuts without sorting or shuffling the rows.

Many reports need only a few ranks of a huge ordering: the row where the training split ends, the k-th best
score, a quantile edge. Each is found by narrowing: quantile sketches propose candidate values, one counting
aggregate tells their exact ranks, and only the value ranges that still hide a wanted rank are looked at
again. Once the open ranges are counted to hold few rows, their values are read and the search ends. Ties on
the first key are resolved by the next key, within the tied rows only.

Sketches are merged in two levels: every task sends its sketches (some tens of kilobytes each) to one of
SKETCH_GROUPS tasks, and the last task merges one sketch per group and column, whatever the number of tasks.
Proposals need not be exact, nor repeatable: the counting pass decides.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.functions.binning import with_interval
from adtally.functions.expressions import add_all

# Values a sketch keeps; with no more rows than that its proposals are exact. Open ranges with no more rows than
# FINISH_ROWS are read.
SKETCH_SIZE = 4_000
SKETCH_GROUPS = 64
FINISH_ROWS = 30_000


def rank_error(size: int) -> float:
    """A bound on the share of rows by which a sketch of `size` values misses a rank."""
    return 3.0 / size**0.9


def sketched_quantiles(
    df: DataFrame, asked: Mapping[str, tuple[Column, Sequence[float]]], *, size: int = SKETCH_SIZE
) -> dict[str, list[float]]:
    """Approximate quantiles of the non-null, non-NaN values of each named column at the given shares.

    They are followed by the exact minimum and maximum, as values of the column's own type.
    """
    if not asked:
        return {}
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group")
    numbers = {name: without_nan(value.cast("double")) for name, (value, _) in asked.items()}
    own = {f"{name}__own": without_nan(value) for name, (value, _) in asked.items()}
    wide = df.select(part, *[value.alias(name) for name, value in (numbers | own).items()])
    sketches = [F.kll_sketch_agg_double(name, size).alias(name) for name in asked]
    ends = [f(name).alias(f"{f.__name__}_{name}") for name in own for f in (F.min, F.max)]
    groups = wide.groupBy("__group").agg(*sketches, *ends)
    ends = [f(f"{f.__name__}_{name}").alias(f"{f.__name__}_{name}") for name in own for f in (F.min, F.max)]
    merged = groups.agg(*[F.kll_merge_agg_double(name).alias(name) for name in asked], *ends)
    found = [F.col(f"{f}_{name}") for name in own for f in ("min", "max")]
    for name, (_, points) in asked.items():
        some = F.when(F.kll_sketch_get_n_double(name) > 0, F.col(name))
        at = F.array(*[F.lit(min(max(float(p), 0.0), 1.0)) for p in points])
        found.append(F.kll_sketch_get_quantile_double(some, at).alias(name))
    row = merged.select(*found).first()
    return {n: [*row[n], row[f"min_{n}__own"], row[f"max_{n}__own"]] if row[n] else [] for n in asked}


@dataclass(frozen=True)
class Ask:
    """Values wanted at 1-based ascending ranks of `column`, among rows where `where` holds."""

    column: Column
    ranks: Sequence[int]
    where: Column | None = None
    rows: int | None = None

    def value(self) -> Column:
        return self.column if self.where is None else F.when(self.where, self.column)


@dataclass(frozen=True)
class Hit:
    """The value at a rank, how many rows lie below it and how many share it."""

    value: float
    below: int
    ties: int


@dataclass
class _Range:
    """An open value range (low, high) known to hold `rows` rows, `offset` rows below it, and wanted `ranks`."""

    ask: int
    ranks: list[int]
    rows: int
    offset: int = 0
    low: float | None = None
    high: float | None = None
    candidates: list[float] = field(default_factory=list)


def _count_rows(df: DataFrame, asks: Sequence[Ask]) -> list[int]:
    unknown = [i for i, ask in enumerate(asks) if ask.rows is None]
    known = {i: ask.rows for i, ask in enumerate(asks) if ask.rows is not None}
    if unknown:
        counts = df.agg(*[F.count(asks[i].value()).alias(str(i)) for i in unknown]).first()
        known.update({i: counts[str(i)] for i in unknown})
    return [known[i] for i in range(len(asks))]


class _Search:
    """The passes over one table on behalf of many asks."""

    def __init__(self, df: DataFrame, asks: Sequence[Ask]):
        self.df, self.asks = df, asks
        types = df.select(*[ask.column.alias(f"c{i}") for i, ask in enumerate(asks)]).schema
        self.integral = [isinstance(f.dataType, T.IntegralType) for f in types]

    def _relevant(self, wanted: Sequence[int]) -> DataFrame:
        """The rows that any of the wanted asks looks at."""
        conditions = [self.asks[i].where for i in wanted]
        if any(condition is None for condition in conditions):
            return self.df
        return self.df.filter(reduce(Column.__or__, conditions))

    def _base(self, item: _Range) -> int:
        # Whole numbers are measured from the lower bound so that doubles hold the distance exactly.
        return item.low if self.integral[item.ask] and item.low is not None else 0

    def propose(self, ranges: list[_Range]) -> None:
        """Give every range candidate values near its wanted ranks."""
        asked = {}
        for i, item in enumerate(ranges):
            value = self.asks[item.ask].value()
            inside = F.lit(True)
            if item.low is not None:
                inside = inside & (value > F.lit(item.low))
            if item.high is not None:
                inside = inside & (value < F.lit(item.high))
            measured = F.when(inside, value - F.lit(self._base(item)) if self._base(item) else value)
            points = [(rank - item.offset - 0.5) / item.rows for rank in item.ranks]
            if item.rows > SKETCH_SIZE:
                # Each rank is bracketed by twice the possible error, so that the gap hiding it is always narrow.
                points = [p + step * rank_error(SKETCH_SIZE) for p in points for step in (-2, 0, 2)]
            asked[f"p{i}"] = (measured, points)
        found = sketched_quantiles(self._relevant([item.ask for item in ranges]), asked)
        for i, item in enumerate(ranges):
            # Proposals for huge whole numbers are rounded; the true extremes guarantee progress.
            values = [int(v) if self.integral[item.ask] else v for v in found[f"p{i}"]]
            item.candidates = sorted({value + self._base(item) for value in values})

    def _positions(self, points: Mapping[int, list[float]]) -> tuple[DataFrame, dict[int, list[int]]]:
        """The table with a column `at<ask>` per ask, and per ask the place code of every number in it.

        For the sorted points of an ask, place 2i lies between points i-1 and i, place 2i+1 equals point i.
        """
        starts, codes = {}, {}
        for i, values in points.items():
            if self.integral[i]:
                codes[i] = list(range(2 * len(values) + 1))
                continue
            above = [math.nextafter(value, math.inf) for value in values]
            splits = sorted({*values, *above} - {math.inf, -math.inf})
            place = {value: 2 * k + 2 for k, value in enumerate(above)}
            place.update({value: 2 * k + 1 for k, value in enumerate(values)})
            codes[i] = [1 if values and values[0] == -math.inf else 0, *[place[split] for split in splits]]
            starts[f"at{i}"] = (self.asks[i].value(), splits)
        table = with_interval(self._relevant(list(points)), starts)
        for i, values in points.items():
            if self.integral[i]:
                value = self.asks[i].value()
                steps = [(value >= F.lit(v)).cast("int") + (value > F.lit(v)).cast("int") for v in values]
                table = table.withColumn(f"at{i}", F.when(value.isNotNull(), add_all(steps)))
        return table, codes

    def measure(self, ranges: list[_Range]) -> list[list[tuple[float | None, int]]]:
        """Per range, its rows in rising order as (candidate or None for a gap, count)."""
        points: dict[int, list[float]] = {}
        for item in ranges:
            bounds = [value for value in (item.low, item.high) if value is not None]
            points.setdefault(item.ask, []).extend([*item.candidates, *bounds])
        points = {i: sorted(set(values)) for i, values in points.items()}
        table, codes = self._positions(points)
        pieces = [piece for i in points for piece in (F.lit(i), F.col(f"at{i}"))]
        long = table.select(F.stack(F.lit(len(points)), *pieces).alias("ask", "at"))
        counts: dict[int, dict[int, int]] = {i: {} for i in points}
        # Bounded: one row per ask and place.
        for row in long.filter(F.col("at").isNotNull()).groupBy("ask", "at").count().collect():
            place = codes[row["ask"]][row["at"]]
            counts[row["ask"]][place] = counts[row["ask"]].get(place, 0) + row["count"]
        result = []
        for item in ranges:
            values = points[item.ask]
            first = 0 if item.low is None else 2 * values.index(item.low) + 2
            last = 2 * len(values) if item.high is None else 2 * values.index(item.high)
            result.append(
                [
                    (values[place // 2] if place % 2 else None, counts[item.ask].get(place, 0))
                    for place in range(first, last + 1)
                ]
            )
        return result

    def read(self, ranges: list[_Range]) -> list[list[tuple[float, int]]]:
        """Per range, every distinct value in it with its count. Only for ranges counted to hold few rows."""
        points: dict[int, set[float]] = {}
        for item in ranges:
            points.setdefault(item.ask, set()).update(v for v in (item.low, item.high) if v is not None)
        bounds = {i: sorted(values) for i, values in points.items()}
        table, codes = self._positions(bounds)
        wanted: dict[int, dict[int, int]] = {i: {} for i in bounds}
        for k, item in enumerate(ranges):
            wanted[item.ask][0 if item.low is None else 2 * bounds[item.ask].index(item.low) + 2] = k
        pieces = []
        for i in bounds:
            numbers = [at for at, place in enumerate(codes[i]) if place in wanted[i]]
            value = F.when(F.col(f"at{i}").isin(numbers), self.asks[i].value())
            whole, real = (value, F.lit(None)) if self.integral[i] else (F.lit(None), value)
            pieces += [F.lit(i), F.col(f"at{i}"), whole.cast("long"), real.cast("double")]
        long = table.select(F.stack(F.lit(len(bounds)), *pieces).alias("ask", "at", "whole", "real"))
        inside = long.filter(F.col("whole").isNotNull() | F.col("real").isNotNull())
        found: list[list[tuple[float, int]]] = [[] for _ in ranges]
        for row in inside.groupBy("ask", "at", "whole", "real").count().collect():
            value = row["whole"] if row["whole"] is not None else row["real"]
            found[wanted[row["ask"]][codes[row["ask"]][row["at"]]]].append((value, row["count"]))
        return [sorted(values) for values in found]


def _settle(
    item: _Range, pieces: Sequence[tuple[float | None, int]], hits: list[dict[int, Hit]]
) -> list[_Range]:
    """Record the ranks that fall on a value; return the gaps that still hide one."""
    open_gaps = []
    below, low, wanted = item.offset, item.low, list(item.ranks)
    for k, (value, count) in enumerate(pieces):
        here = [rank for rank in wanted if below < rank <= below + count]
        if here and value is not None:
            hits[item.ask].update({rank: Hit(value, below, count) for rank in here})
        elif here:
            high = pieces[k + 1][0] if k + 1 < len(pieces) else item.high
            open_gaps.append(_Range(ask=item.ask, ranks=here, rows=count, offset=below, low=low, high=high))
        low = value if value is not None else low
        wanted = [rank for rank in wanted if rank > below + count]
        below += count
    if wanted:
        raise RuntimeError("the input changed between two passes; stage it before selecting ranks")
    return open_gaps


def values_at_ranks(
    df: DataFrame, asks: Sequence[Ask], *, finish_rows: int = FINISH_ROWS
) -> list[dict[int, Hit]]:
    """For every ask, the exact value at each wanted rank. All asks share the same passes over `df`."""
    search = _Search(df, asks)
    hits: list[dict[int, Hit]] = [{} for _ in asks]
    ranges = []
    for i, (ask, rows) in enumerate(zip(asks, _count_rows(df, asks), strict=True)):
        ranks = sorted(set(ask.ranks))
        if ranks and not 1 <= ranks[0] <= ranks[-1] <= rows:
            raise ValueError(f"ranks {ranks[0]}..{ranks[-1]} are outside 1..{rows}")
        if ranks:
            ranges.append(_Range(ask=i, ranks=ranks, rows=rows))
    started = False
    while ranges:
        if started and sum(item.rows for item in ranges) <= finish_rows:
            pieces = search.read(ranges)
        else:
            search.propose(ranges)
            pieces = search.measure(ranges)
        started = True
        ranges = [gap for item, parts in zip(ranges, pieces, strict=True) for gap in _settle(item, parts, hits)]
    return hits


@dataclass(frozen=True)
class Ordering:
    """A total order: ascending non-null sort keys that together identify a row, and the rank cuts wanted."""

    keys: Sequence[Column]
    ranks: Sequence[int]
    where: Column | None = None
    rows: int | None = None


def _at_most(keys: Sequence[Column], bounds: Sequence[float]) -> Column:
    """Rows ordered at or before the bound; a shorter bound takes all ties of its last key."""
    last = len(bounds) - 1
    condition = keys[last] <= F.lit(bounds[last])
    for key, bound in zip(reversed(keys[:last]), reversed(bounds[:last]), strict=True):
        condition = (key < F.lit(bound)) | ((key == F.lit(bound)) & condition)
    return condition


def rank_cuts(df: DataFrame, orderings: Sequence[Ordering]) -> list[dict[int, Column]]:
    """For every ordering and rank r, a condition that holds for exactly the first r rows."""
    cuts: list[dict[int, Column]] = [{} for _ in orderings]
    totals = _count_rows(df, [Ask(F.lit(1), [], o.where, o.rows) for o in orderings])
    pending = []
    for i, (ordering, rows) in enumerate(zip(orderings, totals, strict=True)):
        inner = []
        for rank in sorted(set(ordering.ranks)):
            if 0 < rank < rows:
                inner.append(rank)
            else:
                cuts[i][rank] = F.lit(rank > 0)
        if inner:
            pending.append((i, (), 0, rows, inner))
    while pending:
        asks = []
        for i, bounds, _, rows, ranks in pending:
            keys, where = orderings[i].keys, orderings[i].where
            if len(bounds) == len(keys):
                raise ValueError("the ordering keys do not identify rows: a cut falls between equal rows")
            for key, bound in zip(keys, bounds):
                tied = key == F.lit(bound)
                where = tied if where is None else where & tied
            asks.append(Ask(keys[len(bounds)], ranks, where, rows))
        following = []
        for (i, bounds, offset, _, _), ask, hits in zip(pending, asks, values_at_ranks(df, asks), strict=True):
            split_ties: dict[float, tuple[Hit, list[int]]] = {}
            for rank in ask.ranks:
                hit = hits[rank]
                if rank == hit.below + hit.ties:
                    cuts[i][offset + rank] = _at_most(orderings[i].keys, (*bounds, hit.value))
                else:
                    split_ties.setdefault(hit.value, (hit, []))[1].append(rank - hit.below)
            for value, (hit, ranks) in split_ties.items():
                following.append((i, (*bounds, value), offset + hit.below, hit.ties, ranks))
        pending = following
    return cuts


def without_nan(column: Column) -> Column:
    """Not-a-number as null: it has no rank."""
    return F.when(~F.isnan(column), column)


def first_k(rows: int, fraction: float) -> int:
    """Rows in the top fraction: at least one, otherwise the product cut to a whole number."""
    return max(1, int(rows * fraction))


def interpolate(low: float, high: float, share: float) -> float:
    """The point between two values, measured from the nearer one."""
    return high - (high - low) * (1 - share) if share >= 0.5 else low + (high - low) * share


def quantile_positions(rows: int, bins: int) -> list[float]:
    """0-based positions of the bins + 1 equally spaced quantiles of `rows` sorted values."""
    step = 1.0 / bins
    shares = [i * step for i in range(bins)] + [1.0]
    # The detour over percent reproduces the rounding of the positions that quantile edges are defined by.
    return [(share * 100 / 100) * (rows - 1) for share in shares]


def quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    *,
    bins: int,
    where: Column | None = None,
    limit_bins_to_rows: bool = False,
) -> dict[str, list[float]]:
    """Linearly interpolated exact quantiles, from minimum to maximum, of every column's non-null values.

    An empty column gives an empty list.
    """
    names, columns = list(columns), {name: without_nan(column) for name, column in columns.items()}
    counts = _count_rows(df, [Ask(columns[name], [], where) for name in names])
    positions: list[list[float]] = []
    asks = []
    for name, rows in zip(names, counts, strict=True):
        parts = min(bins, rows) if limit_bins_to_rows else bins
        positions.append(quantile_positions(rows, parts) if rows else [])
        ranks = {min(math.floor(h) + up, rows) for h in positions[-1] for up in (1, 2)}
        asks.append(Ask(columns[name], sorted(ranks), where, rows))
    found = {}
    for name, rows, at, hits in zip(names, counts, positions, values_at_ranks(df, asks), strict=True):
        value = lambda rank: float(hits[min(rank, rows)].value)  # noqa: B023, E731
        found[name] = [interpolate(value(math.floor(h) + 1), value(math.floor(h) + 2), h - math.floor(h)) for h in at]
    return found


def quantile_edges(df: DataFrame, columns: Mapping[str, Column], **options) -> dict[str, list[float]]:
    """The distinct quantiles in rising order, as bin edges."""
    return {name: sorted(set(values)) for name, values in quantiles(df, columns, **options).items()}


def medians(df: DataFrame, columns: Mapping[str, Column], where: Column | None = None) -> dict[str, float | None]:
    """Exact medians (mean of the middle two) of the non-null values; None for an empty column."""
    names, columns = list(columns), {name: without_nan(column) for name, column in columns.items()}
    counts = _count_rows(df, [Ask(columns[name], [], where) for name in names])
    asks = [
        Ask(columns[name], sorted({(rows + 1) // 2, rows // 2 + 1}) if rows else [], where, rows)
        for name, rows in zip(names, counts, strict=True)
    ]
    result: dict[str, float | None] = {}
    for name, rows, hits in zip(names, counts, values_at_ranks(df, asks), strict=True):
        middle = [float(hits[rank].value) for rank in ((rows + 1) // 2, rows // 2 + 1)] if rows else []
        result[name] = sum(middle) / 2 if middle else None
    return result
