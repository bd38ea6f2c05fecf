"""Per-row global ranks.

Two shapes are needed. Average ranks (ties share a rank) use value buckets: approximate boundaries, exact
bucket counts, and a window over (row number, value) pairs inside each bucket. Unique row numbers range-partition the rows by the full
ordering, write them once, and add each partition's starting offset. Neither ever sorts the table in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.binning import with_interval
from adtally.operators.selection import sketched_quantiles
from adtally.sources.staging import stage

ROWS_PER_BUCKET = 20_000
MIN_BUCKETS = 64
MAX_BUCKETS = 16_384
MAX_SKETCH = 16_384
ROWS_PER_TASK = 2_000_000


def task_count(df: DataFrame, rows: int) -> int:
    """Shuffle partitions for `rows` rows: the session's number, or more where tasks would grow too large."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


@dataclass(frozen=True)
class Buckets:
    """Strictly increasing bucket starts of a column and its number of non-null rows."""

    starts: list[float]
    rows: int


def value_buckets(
    df: DataFrame, columns: Mapping[str, Column], *, rows_per_bucket: int = ROWS_PER_BUCKET
) -> dict[str, Buckets]:
    """Buckets of about `rows_per_bucket` rows per column.

    The driver receives at most MAX_BUCKETS numbers per column. A value that fills several buckets shows up
    as one repeated boundary; it is kept apart by a second split just above it.
    """
    names = list(columns)
    counts = df.agg(*[F.count(columns[name]).alias(name) for name in names]).first()
    most = max([counts[name] for name in names], default=0)
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, math.ceil(most / rows_per_bucket)))
    points = [i / buckets for i in range(1, buckets)]
    row = sketched_quantiles(df, {name: (columns[name], points) for name in names}, size=min(MAX_SKETCH, 4 * buckets))
    buckets_of = {}
    for name in names:
        starts: set[float] = set()
        for boundary in map(float, row[name] or [0.0]):
            starts |= {boundary, math.nextafter(boundary, math.inf)}
        buckets_of[name] = Buckets(sorted(start for start in starts if math.isfinite(start)), counts[name])
    return buckets_of


def with_bucket(df: DataFrame, column: Column, buckets: Buckets, output: str) -> DataFrame:
    """Bucket number by binary search; -1 for null."""
    numbered = with_interval(df, {output: (column, buckets.starts)})
    return numbered.withColumn(output, F.coalesce(F.col(output), F.lit(-1)))


def _bucket_totals(df: DataFrame, columns: Mapping[str, Column], buckets: Mapping[str, Buckets]) -> DataFrame:
    """(name, __bucket, __one_value, __base) of all columns, counted in one pass.

    `__base` is the number of rows in lower buckets, or the shared rank itself where one value fills a bucket.
    """
    numbers = {name: f"bucket_{i}" for i, name in enumerate(columns)}
    wide = with_interval(df, {numbers[name]: (column, buckets[name].starts) for name, column in columns.items()})
    pieces = []
    for name, column in columns.items():
        pieces += [F.lit(name), F.coalesce(F.col(numbers[name]), F.lit(-1)), column.cast("double")]
    long = wide.select(F.stack(F.lit(len(columns)), *pieces).alias("name", "bucket", "value"))
    totals = long.groupBy("name", "bucket").agg(
        F.count("value").alias("bucket_rows"),
        # Doubles hold whole numbers exactly only below 2^53; beyond, different ones may look alike.
        F.coalesce(
            (F.min("value") == F.max("value")) & (F.abs(F.min("value")) < F.lit(2.0**53)), F.lit(True)
        ).alias("one_value"),
    )
    # At most columns x (2 * MAX_BUCKETS + 2) rows: small windows here, a bounded broadcast later.
    in_order = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bucket_rows").over(in_order), F.lit(0)).cast("double")
    shared = F.when(F.col("one_value"), (F.col("bucket_rows") + 1) / F.lit(2.0)).otherwise(0.0)
    return totals.select(
        "name",
        F.col("bucket").alias("__bucket"),
        F.col("one_value").alias("__one_value"),
        (before + shared).alias("__base"),
    )


def _ranked(numbered: DataFrame, column: Column, buckets: Buckets, totals: DataFrame) -> DataFrame:
    """(__row, rank) of the rows that have a value: only row numbers and values are ordered."""
    named = numbered.select("__row", column.alias("__value")).filter(F.col("__value").isNotNull())
    # One row per bucket is broadcast.
    bucketed = with_bucket(named, F.col("__value"), buckets, "__bucket").join(F.broadcast(totals), "__bucket")
    # Rows of a bucket holding one value need no order, however many they are.
    single = bucketed.filter("__one_value").select("__row", F.col("__base").alias("rank"))
    rest = bucketed.filter(~F.col("__one_value")).select("__row", "__bucket", "__value", "__base")
    tasks = task_count(numbered, buckets.rows)
    if tasks > task_count(numbered, 0):
        # Adaptive execution merges shuffle partitions but never adds any.
        rest = rest.repartition(tasks, "__bucket")
    inside = Window.partitionBy("__bucket").orderBy("__value")
    ties = F.count(F.lit(1)).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    rank = F.col("__base") + F.rank().over(inside) + (ties - 1) / F.lit(2.0)
    return single.unionByName(rest.select("__row", rank.alias("rank")))


def with_average_ranks(
    df: DataFrame,
    columns: Mapping[str, Column],
    *,
    as_share: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Ascending rank per column with ties sharing their mean rank, null for null.

    The rank is divided by the column's non-null count unless `as_share` is off. Boundaries and bucket counts
    of all columns come from shared passes over `df`. Columns of few distinct values are ranked without moving a row.
    For all others the rows are numbered and written; (row number, value) pairs are ranked, and the ranks of all
    columns meet the rows in one join by number: whole rows are shuffled once, whatever the number of columns.
    """
    buckets = value_buckets(df, columns, rows_per_bucket=rows_per_bucket)
    # Counted once and read back, so that ranking the next column does not recount the one before.
    totals = stage(_bucket_totals(df, columns, buckets), "buckets")
    mixed = {row["name"] for row in totals.filter(~F.col("__one_value")).select("name").distinct().collect()}
    own = {name: totals.filter(F.col("name") == name).drop("name") for name in columns}
    kept = [name for name in df.columns if name not in columns]
    shares = {name: F.lit(float(buckets[name].rows)) if as_share else F.lit(1.0) for name in columns}
    # Values are read before an output may take the place of its column.
    base = df.withColumns({f"__value{i}": column for i, column in enumerate(columns.values())}).select(*kept, *[f"__value{i}" for i in range(len(columns))])
    places = {name: i for i, name in enumerate(columns)}
    if mixed:
        base = stage(base.withColumn("__row", F.monotonically_increasing_id()), "numbered")
        parts = [
            _ranked(base, F.col(f"__value{places[name]}"), buckets[name], own[name]).withColumn("__place", F.lit(places[name])) for name in sorted(mixed)
        ]
        pairs = parts[0]
        for part in parts[1:]:
            pairs = pairs.unionByName(part)
        found = pairs.groupBy("__row").agg(
            *[F.max(F.when(F.col("__place") == places[name], F.col("rank"))).alias(f"__rank{places[name]}") for name in sorted(mixed)]
        )
        base = base.join(found, "__row", "left").drop("__row")
    for name, i in places.items():
        if name in mixed:
            continue
        # Every bucket holds one value, its rank is known, and no row has to move.
        bucketed = with_bucket(base, F.col(f"__value{i}"), buckets[name], "__bucket").join(F.broadcast(own[name]), "__bucket")
        rank = F.when(F.col(f"__value{i}").isNotNull(), F.col("__base"))
        base = bucketed.withColumn(f"__rank{i}", rank).drop("__bucket", "__one_value", "__base")
    return base.select(*kept, *[(F.col(f"__rank{i}") / shares[name]).alias(name) for name, i in places.items()])


def with_row_number(
    df: DataFrame,
    order: Sequence[Column],
    output: str,
    *,
    running: Mapping[str, Column] | None = None,
    rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """1-based position under `order`, plus running sums in that order.

    `order` should identify rows (rows equal on it are numbered in some order). The range partitioner samples
    the whole ordering, tie-break keys included, so one tied score does not overload a partition. The numbered
    rows are written before the offsets are read: both jobs then see the same partitions.
    """
    partitions = partitions or task_count(df, df.count() if rows is None else rows)
    running = dict(running or {})
    slotted = (
        df.withColumns({f"__add_{name}": column for name, column in running.items()})
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("__slot", F.monotonically_increasing_id())
    )
    # The generated id holds the partition in its upper 31 bits and the position within it in the lower 33.
    table = stage(slotted, "ordered").withColumn("__part", F.shiftright("__slot", 33))
    sizes = table.groupBy("__part").agg(
        F.count(F.lit(1)).alias("part_rows"), *[F.sum(f"__add_{name}").alias(f"sum_{name}") for name in running]
    )
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part",
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("__rows_before"),
        *[F.coalesce(F.sum(f"sum_{name}").over(before), F.lit(0)).alias(f"__before_{name}") for name in running],
    )
    # One row per range partition: bounded by the partition count.
    joined = table.join(F.broadcast(offsets), "__part")
    within = Window.partitionBy("__part").orderBy("__slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.col("__rows_before") + F.col("__slot").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return joined.select(
        *[F.col(name) for name in df.columns],
        position.alias(output),
        *[(F.col(f"__before_{name}") + F.sum(f"__add_{name}").over(within)).alias(name) for name in running],
    )
