"""Shards of near-equal size by a k-d tree over metadata.

Every row has a point: one whole number per metadata dimension (numbers as they are, texts by a hash, so that
equal texts of a dimension lie together). A node of the tree is split along its widest dimension, widths being
shares of the whole table's, at the weighted median: the place where the rows before it hold the part of the
node's bytes that its shards on that side are due. Nodes are split until each holds one shard, or, with `target_bytes`, until the leaves
reach that size.

Medians are found by distributed histograms, all nodes of a level at once: bytes per (node, bucket), a running
sum over a node's buckets, then the one bucket that holds the median is looked into again. Where one value
holds too many bytes, its rows are ordered by a hash of the text, so that equal texts stay together as long as
they are small against a shard, and last by a hash of the row. A hot value, text or repeated row is thus split like any
other. The driver holds one row per node: as many as there are shards. Rows are never shuffled; only
histograms are.

Defined results: a null text has 0 bytes, and every row weighs one byte more than its text. A null in a
dimension stands with the smallest value. Repeated rows are rows of their own. An empty table gives no rows;
with fewer rows than shards some shards stay empty. Only the named columns are read, and the columns of `keep`
are carried under generated names, so further columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.sources.staging import release, stage

BUCKETS = 4_096
# A cut may miss its place by this share of a shard's due bytes; equal texts are kept on one side up to the larger share.
TOLERANCE = 0.002
TOGETHER = 0.01
FIRST, LAST = -(1 << 62), (1 << 62) - 1


def _coordinate(df: DataFrame, name: str) -> Column:
    """A whole number between FIRST and LAST, ordered like the column; null for null."""
    kind = df.schema[name].dataType
    value = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        value = F.when(value.isNotNull(), F.xxhash64(value))
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value).cast("long") * 2
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"dimension {name} must hold whole numbers, texts, dates or times")
    else:
        value = value.cast("long")
    # Half the range, so that differences stay within 64 bits.
    return F.shiftright(value, 1)


@dataclass
class _Split:
    """One node's search: the key it looks at, the values still open, and what is known to lie before them."""

    node: int
    key: int
    dimension: int
    due: float
    low: int
    high: int
    before: int = 0
    cut: tuple[int, int, int] | None = None
    fixed: tuple[int, ...] = ()

    def at(self, value: int) -> tuple[int, int, int]:
        """The cut behind `value` of the key looked at."""
        whole = (*self.fixed, value, LAST, LAST)
        return whole[:3]


def _small(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """One row per node of a level, at most as many as shards, for every task."""
    listed = ", ".join("(" + ", ".join(f"{v!r}D" if isinstance(v, float) else str(v) for v in row) + ")" for row in rows)
    names, kinds = zip(*(field.split() for field in schema.split(", ")), strict=True)
    table = df.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS nodes({', '.join(names)})")
    return F.broadcast(table.select(*[F.col(name).cast(kind) for name, kind in zip(names, kinds, strict=True)]))


class _Tree:
    """Grows the tree over `rows`: columns d0.. (dimensions), tie, spread, size, and node, zero in all."""

    def __init__(self, rows: DataFrame, dimensions: int):
        self.rows, self.dimensions = rows, dimensions
        self.keys = [*[f"d{i}" for i in range(dimensions)], "tie", "spread"]
        self.placed = rows

    def _stats(self) -> dict[int, dict]:
        ends = [f(F.col(f"d{i}")).alias(f"{f.__name__}{i}") for i in range(self.dimensions) for f in (F.min, F.max)]
        found = self.placed.groupBy("node").agg(F.sum("size").alias("size"), *ends).collect()
        return {row["node"]: row.asDict() for row in found}

    def grow(self, shards: int) -> list[int]:
        """Splits level by level; the shard of every leaf node."""
        parts = [shards]
        root: dict | None = None
        while max(parts) > 1:
            stats = self._stats()
            root = root or stats[0]
            splits = []
            for node, part in enumerate(parts):
                if part > 1 and node in stats:
                    splits.append(self._begin(node, part, stats[node], root))
            self._search(splits, max(1.0, root["size"] / shards))
            cuts = {split.node: split for split in splits}
            # A finished leaf sends all its rows to the left.
            dims = [cuts[n].dimension if n in cuts else 0 for n in range(len(parts))]
            ends = [cuts[n].cut if n in cuts else (LAST, LAST, LAST) for n in range(len(parts))]
            self._descend(dims, ends)
            parts = [half for part in parts for half in ((part // 2, part - part // 2) if part > 1 else (part, 0))]
        shard_of, next_shard = [], 0
        for part in parts:
            shard_of.append(next_shard)
            next_shard += part
        return shard_of

    def _begin(self, node: int, part: int, stats: dict, root: dict) -> _Split:
        def width(i: int) -> float:
            whole = root[f"max{i}"] - root[f"min{i}"]
            return (stats[f"max{i}"] - stats[f"min{i}"]) / whole if whole else 0.0

        widest = max(range(self.dimensions), key=lambda i: (width(i), -i))
        due = stats["size"] * (part // 2) / part
        return _Split(node, widest, widest, due, stats[f"min{widest}"], stats[f"max{widest}"])

    def _value(self, key: Column) -> Column:
        return F.get(F.array(*[F.col(name) for name in self.keys]), key)

    def _search(self, splits: list[_Split], shard_bytes: float) -> None:
        """Finds the cut of every split; each pass is one aggregate over the rows of the open nodes."""
        open_splits = list(splits)
        while open_splits:
            for split, found in self._histogram(open_splits):
                weight, low, high = found["weight"], found["low"], found["high"]
                before = split.before + found["below"]
                single = low == high
                last_key = len(split.fixed) == 2
                small = weight <= TOLERANCE * shard_bytes or (len(split.fixed) == 1 and single and weight <= TOGETHER * shard_bytes)
                if small or (single and last_key):
                    split.cut = split.at(low - 1 if split.due - before < weight / 2 else high)
                elif single:
                    # All of one value: go on with the next key inside it.
                    split.fixed = (*split.fixed, low)
                    split.key = self.dimensions + len(split.fixed) - 1
                    split.low, split.high, split.before = FIRST, LAST, before
                else:
                    split.low, split.high, split.before = low, high, before
            open_splits = [split for split in open_splits if split.cut is None]

    def _histogram(self, splits: list[_Split]) -> list[tuple[_Split, dict]]:
        """Per open node the bucket that holds its place: bytes below it, its bytes, its smallest and largest value."""
        table = [
            (x.node, x.key, x.dimension, len(x.fixed), *[*x.fixed, 0, 0][:2], x.low, x.high, (x.high - x.low) // BUCKETS + 1, x.due - x.before)
            for x in splits
        ]
        schema = "node long, key int, dimension int, depth int, value0 long, value1 long, low long, high long, step long, due double"
        rows = self.placed.join(_small(self.placed, table, schema), "node").withColumn("value", self._value(F.col("key")))
        first = self._value(F.col("dimension"))
        rows = rows.filter(
            ((F.col("depth") < 1) | (first == F.col("value0"))) & ((F.col("depth") < 2) | (F.col("tie") == F.col("value1")))
            & F.col("value").between(F.col("low"), F.col("high"))
        )
        bucket = F.floor((F.col("value") - F.col("low")) / F.col("step"))
        cells = rows.groupBy("node", "due", bucket.alias("bucket")).agg(
            F.sum("size").alias("weight"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        upto = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = cells.withColumn("upto", F.sum("weight").over(upto))
        # The first bucket that reaches the place; what is due never exceeds the bytes that are open.
        reached = running.filter(F.col("upto") >= F.col("due")).groupBy("node").agg(
            F.min(F.struct("bucket", "upto", "weight", "low", "high")).alias("cell")
        )
        found = {row["node"]: row["cell"].asDict() for row in reached.collect()}
        return [(x, found[x.node] | {"below": found[x.node]["upto"] - found[x.node]["weight"]}) for x in splits]

    def _descend(self, dims: Sequence[int], ends: Sequence[tuple[int, int, int]]) -> None:
        table = [(node, dim, *end) for node, (dim, end) in enumerate(zip(dims, ends, strict=True))]
        rows = self.placed.join(_small(self.placed, table, "node long, dimension int, a long, b long, c long"), "node")
        value, a, b, c = self._value(F.col("dimension")), F.col("a"), F.col("b"), F.col("c")
        left = (value < a) | ((value == a) & ((F.col("tie") < b) | ((F.col("tie") == b) & (F.col("spread") <= c))))
        node = F.col("node") * 2 + F.when(left, 0).otherwise(1)
        self.placed = rows.withColumn("node", node).select(*self.placed.columns)


def shard_by_bytes(
    df: DataFrame,
    *,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = ("lang", "source", "doc_id"),
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns of `keep`, size, text_crc32, shard (from 0) and slot (gapless from 0 within the shard).

    Give either the number of shards or the bytes a shard should have.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    keep = list(dict.fromkeys(keep))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    made = {"size": F.octet_length(text).cast("long") + 1, "crc": F.crc32(text.cast("binary")), "row": F.monotonically_increasing_id(), "node": F.lit(0).cast("long")}
    made |= {f"d{i}": _coordinate(df, name) for i, name in enumerate(dimensions)}
    made |= {"tie": F.shiftright(F.xxhash64(text), 1)}
    carried = [F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)]
    rows = stage(df.select(*carried, *[value.alias(name) for name, value in made.items()]), "points")
    lows = rows.agg(F.sum("size").alias("total"), *[F.min(f"d{i}").alias(f"d{i}") for i in range(len(dimensions))]).first()
    total = lows["total"] or 0
    shards = shards or max(1, math.ceil(total / target_bytes))
    points = rows.withColumns({f"d{i}": F.coalesce(f"d{i}", F.lit(lows[f"d{i}"] or 0).cast("long")) for i in range(len(dimensions))})
    points = points.withColumn("spread", F.shiftright(F.xxhash64("row"), 1))
    tree = _Tree(points, len(dimensions))
    shard_of = tree.grow(shards) if total else [0]
    of_node = _small(points, list(enumerate(shard_of)), "node long, shard int")
    # Sorted inside its partition, a shard's rows of one partition lie together: a slot is the shard's rows in earlier
    # partitions plus the distance from the first of them. No row is moved.
    sorted_rows = tree.placed.join(of_node, "node").select(*[f"k{i}" for i in range(len(keep))], "size", "crc", "shard")
    sorted_rows = sorted_rows.sortWithinPartitions("shard").withColumn("at", F.monotonically_increasing_id())
    written = stage(sorted_rows, "sharded").withColumn("part", F.shiftright("at", 33))
    release(rows)
    starts = written.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("start"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        F.col("shard").alias("own_shard"), F.col("part").alias("own_part"), "start",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
    )
    joined = written.join(starts, (F.col("shard") == F.col("own_shard")) & (F.col("part") == F.col("own_part")))
    slot = F.col("before") + F.col("at") - F.col("start")
    out = joined.select(*[f"k{i}" for i in range(len(keep))], "size", "crc", "shard", slot.alias("slot"))
    return out.toDF(*keep, "size", "text_crc32", "shard", "slot")


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard with the kept columns."""
    sharded.write.partitionBy("shard").parquet(folder)
