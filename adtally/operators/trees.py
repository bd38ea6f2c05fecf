"""Boosted trees from histograms: second-order gains, leaf penalty, rows and columns sampled per tree.

Every input is cut into at most `max_bins` bins once. A level of a tree is one aggregate: gradients and
curvatures summed per (node, input, bin), running sums over a node's bins, and the best split per node. The
driver receives one row per node, so work and memory on it follow the tree and not the data. Gains are compared
at nine digits, the first input and the lowest cut winning ties: neither the order of sums nor a retry changes a tree.

Rows are sampled by a hash of their written number, inputs by the seed. Scores start from the label's mean.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.binning import with_right_closed_bin
from adtally.operators.linear import logistic
from adtally.operators.selection import quantile_edges
from adtally.sources.staging import release, stage

MAX_BINS = 256
GAIN_DIGITS = 9
# Leaf penalty and least curvature of a child, the usual defaults of second-order boosting.
LEAF_PENALTY = 1.0
LEAST_CURVATURE = 1.0
EMPTY_GAIN = 0.0


@dataclass(frozen=True)
class TreeSettings:
    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    rows: float = 1.0
    inputs: float = 1.0
    seed: int = 42
    bins: int = MAX_BINS

    @staticmethod
    def of(params: Mapping[str, Any]) -> TreeSettings:
        """From the public names of the boosted-tree parameters."""
        return TreeSettings(
            int(params["n_estimators"]), int(params["max_depth"]), float(params["learning_rate"]),
            float(params["subsample"]), float(params["colsample_bytree"]), int(params["random_state"]),
        )


def cut_points(rows: DataFrame, inputs: Sequence[str], bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Rising cuts per input; a row goes left of a cut if its value is at most the cut.

    Every distinct value but the largest where there are at most `bins`, else the inner exact quantiles.
    """
    about = rows.agg(*[F.approx_count_distinct(name).alias(name) for name in inputs]).first()
    short = [name for name in inputs if about[name] <= 2 * bins]
    found: dict[str, list[float]] = {name: [] for name in inputs}
    if short:
        pairs = [item for name in short for item in (F.lit(name), F.col(name).cast("double"))]
        values = rows.select(F.stack(F.lit(len(short)), *pairs).alias("name", "value")).distinct()
        # At most some 2 * bins values per input.
        for row in values.filter("value is not null").collect():
            found[row["name"]].append(row["value"])
    cuts = {name: sorted(found[name])[:-1] for name in short if len(found[name]) <= bins}
    wide = [name for name in inputs if name not in cuts]
    if wide:
        edges = quantile_edges(rows, {name: F.col(name).cast("double") for name in wide}, bins=bins)
        cuts |= {name: edges[name][1:-1] for name in wide}
    return {name: cuts[name] for name in inputs}


def histogram(rows: DataFrame, inputs: Sequence[int]) -> DataFrame:
    """(node, input, bin, g, h, rows) from rows with node, g, h and the bins b0, b1, ..."""
    pairs = [item for i in inputs for item in (F.lit(i), F.col(f"b{i}"))]
    long = rows.select("node", "g", "h", F.stack(F.lit(len(inputs)), *pairs).alias("input", "bin"))
    return long.groupBy("node", "input", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("rows"))


def split_gains(cells: DataFrame) -> DataFrame:
    """(node, input, bin, gain, left_g, left_h, right_g, right_h, rows): every split behind a bin that is not the node's last."""
    upto = Window.partitionBy("node", "input").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("node", "input")
    sums = cells.withColumns(
        {"left_g": F.sum("g").over(upto), "left_h": F.sum("h").over(upto), "all_g": F.sum("g").over(whole), "all_h": F.sum("h").over(whole),
         "last": F.max("bin").over(whole), "rows": F.sum("rows").over(whole)}
    )
    sums = sums.withColumns({"right_g": F.col("all_g") - F.col("left_g"), "right_h": F.col("all_h") - F.col("left_h")})

    def part(side: str) -> Column:
        return F.col(f"{side}_g") * F.col(f"{side}_g") / (F.col(f"{side}_h") + LEAF_PENALTY)

    enough = (F.col("left_h") >= LEAST_CURVATURE) & (F.col("right_h") >= LEAST_CURVATURE)
    gain = F.round(0.5 * (part("left") + part("right") - part("all")), GAIN_DIGITS)
    return sums.filter((F.col("bin") < F.col("last")) & enough).select(
        "node", "input", "bin", gain.alias("gain"), "left_g", "left_h", "right_g", "right_h", "rows"
    )


def best_splits(gains: DataFrame) -> DataFrame:
    """The split of each node with the largest positive gain; ties go to the first input, then to the lowest cut."""
    rank = F.struct("gain", (-F.col("input")).alias("i"), (-F.col("bin")).alias("b"), "left_g", "left_h", "right_g", "right_h")
    best = gains.filter(F.col("gain") > EMPTY_GAIN).groupBy("node").agg(F.max(rank).alias("best"))
    return best.select("node", (-F.col("best.i")).alias("input"), (-F.col("best.b")).alias("bin"), "best.*").drop("i", "b")


def _node_of(tree: Mapping[int, tuple[int, float]], node: int, value) -> Column:
    """The leaf of a row in a tree {node: (input, cut)}; children of node n are 2n + 1 and 2n + 2."""
    if node not in tree:
        return F.lit(node)
    i, cut = tree[node]
    return F.when(value(i) <= F.lit(cut), _node_of(tree, 2 * node + 1, value)).otherwise(_node_of(tree, 2 * node + 2, value))


def _leaf(g: float, h: float, rate: float) -> float:
    return -rate * g / (h + LEAF_PENALTY)


def _grow(rows: DataFrame, inputs: Sequence[int], settings: TreeSettings) -> tuple[dict[int, tuple[int, int]], dict[int, float]]:
    """One tree on rows with g, h and bins: its splits {node: (input, bin)} and its leaves' values."""
    splits: dict[int, tuple[int, int]] = {}
    leaves: dict[int, float] = {}
    for level in range(settings.depth):
        placed = rows.withColumn("node", _node_of(splits, 0, lambda i: F.col(f"b{i}")))
        if level:
            placed = placed.filter(F.col("node") >= 2**level - 1)
        found = best_splits(split_gains(histogram(placed, inputs))).collect()
        for row in found:
            splits[row["node"]] = (row["input"], row["bin"])
            leaves.pop(row["node"], None)
            leaves[2 * row["node"] + 1] = _leaf(row["left_g"], row["left_h"], settings.rate)
            leaves[2 * row["node"] + 2] = _leaf(row["right_g"], row["right_h"], settings.rate)
        if not found:
            break
    if not splits:
        total = rows.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).first()
        leaves = {0: _leaf(total["g"] or 0.0, total["h"] or 0.0, settings.rate)}
    return splits, leaves


def fit_trees(rows: DataFrame, inputs: Sequence[str], label_col: str, settings: TreeSettings, *, probability: bool) -> TreeScorer:
    """Boosted trees for a 0/1 label (log loss) or a number (squared error). Inputs must not hold nulls."""
    label = F.col(label_col).cast("double")
    start = rows.agg(F.avg(label)).first()[0]
    if start is None or (probability and not 0.0 < start < 1.0):
        raise ValueError(f"boosted trees need rows of both labels, the mean of {label_col} is {start}")
    base = math.log(start / (1.0 - start)) if probability else start
    cuts = cut_points(rows, inputs, settings.bins)
    binned = with_right_closed_bin(rows, {f"b{i}": (F.col(name), cuts[name]) for i, name in enumerate(inputs)})
    binned = binned.select(*[f"b{i}" for i in range(len(inputs))], label.alias("label"), F.lit(float(base)).alias("margin"), F.monotonically_increasing_id().alias("number"))
    current = stage(binned, "binned")
    rng = np.random.default_rng(settings.seed)
    usable = [i for i, name in enumerate(inputs) if cuts[name]]
    trees = []
    for number in range(settings.trees):
        chosen = sorted(rng.permutation(usable)[: max(1, round(settings.inputs * len(usable)))].tolist()) if usable else []
        seen = logistic(F.col("margin")) if probability else F.col("margin")
        curved = current.withColumn("p", seen).withColumns(
            {"g": F.col("p") - F.col("label"), "h": F.col("p") * (1.0 - F.col("p")) if probability else F.lit(1.0)}
        )
        if settings.rows < 1.0:
            draw = F.pmod(F.xxhash64(F.lit(settings.seed + number), "number"), F.lit(1 << 30)) / float(1 << 30)
            curved = curved.filter(draw < settings.rows)
        splits, leaves = _grow(curved, chosen, settings) if chosen else ({}, {0: 0.0})
        value = _leaf_value(splits, leaves, 0, lambda i: F.col(f"b{i}"))
        if number + 1 < settings.trees:
            later = stage(current.withColumn("margin", F.col("margin") + value), "binned")
            release(current)
            current = later
        trees.append({
            "splits": {str(n): [i, cuts[inputs[i]][b]] for n, (i, b) in splits.items()}, "leaves": {str(n): v for n, v in leaves.items()},
        })
    release(current)
    return TreeScorer(inputs, {"base": base, "depth": settings.depth, "trees": trees}, probability)


def _leaf_value(splits: Mapping[int, tuple[int, float]], leaves: Mapping[int, float], node: int, value) -> Column:
    if node not in splits:
        return F.lit(float(leaves[node]))
    i, cut = splits[node]
    sides = [_leaf_value(splits, leaves, 2 * node + k, value) for k in (1, 2)]
    return F.when(value(i) <= F.lit(cut), sides[0]).otherwise(sides[1])


class TreeScorer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted boosted trees: adds `prediction`, the probability of label 1 or the predicted value.

    Trees are arrays: input and cut per inner node, value per leaf. A row walks them by lookups, so the plan has the
    same size whatever the number of trees.
    """

    inputs = Param(Params._dummy(), "inputs", "input columns", TypeConverters.toListString)
    ensemble = Param(Params._dummy(), "ensemble", "the trees as JSON", TypeConverters.toString)
    probability = Param(Params._dummy(), "probability", "whether the prediction is a probability", TypeConverters.toBoolean)

    def __init__(self, inputs: Sequence[str] = (), ensemble: Mapping[str, Any] | None = None, probability: bool = False):
        super().__init__()
        self._set(inputs=list(inputs), ensemble=json.dumps(ensemble or {"base": 0.0, "depth": 0, "trees": []}), probability=probability)

    @property
    def trees(self) -> dict[str, Any]:
        return json.loads(self.getOrDefault(self.ensemble))

    def margin(self) -> Column:
        spec = self.trees
        places = 2 ** (spec["depth"] + 1) - 1
        count = len(spec["trees"])
        own, cut, leaf = np.full(count * places, -1), np.zeros(count * places), np.zeros(count * places)
        for t, tree in enumerate(spec["trees"]):
            for node, (i, value) in tree["splits"].items():
                own[t * places + int(node)], cut[t * places + int(node)] = i, value
            for node, value in tree["leaves"].items():
                leaf[t * places + int(node)] = value
        if not count:
            return F.lit(float(spec["base"]))
        row = F.array(*[F.col(name).cast("double") for name in self.getOrDefault(self.inputs)])
        own, cut, leaf = F.lit(own.tolist()), F.lit(cut.tolist()), F.lit(leaf.tolist())

        def walk(start: Column) -> Column:
            """The place of the leaf of the tree whose root is at `start`."""

            def step(node: Column, _: Column) -> Column:
                at = start + node
                right = (F.get(row, F.get(own, at)) > F.get(cut, at)).cast("int")
                return F.when(F.get(own, at) < 0, node).otherwise(2 * node + 1 + right)

            return F.aggregate(F.sequence(F.lit(1), F.lit(spec["depth"])), F.lit(0), step)

        roots = F.sequence(F.lit(0), F.lit((count - 1) * places), F.lit(places))
        return F.aggregate(roots, F.lit(float(spec["base"])), lambda total, root: total + F.get(leaf, root + walk(root)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = self.margin()
        return dataset.withColumn("prediction", logistic(margin) if self.getOrDefault(self.probability) else margin)
