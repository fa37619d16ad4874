"""Regression forest built level by level from histograms.

Each feature is cut into bins at exact quantiles of the training rows.  For every level one aggregate adds up, for all
open nodes of all trees at once, the weights and labels of each (tree, node, feature, bin).  Prefix sums over the bins
give each split's reduction of the squared error, and the best split of a node is kept.  Labels are
whole millionths (``LABEL_UNIT``), so sums are exact and the trees are the same for any partitioning; ties go
to the first feature and lowest bin.

A row counts in a tree as often as a Poisson draw from its key says, which is drawing with replacement without
a second pass.  A node looks at a third of the features, rounded up, drawn by its number.

The driver receives one row for each node.  Rows without a label or without a key do not train; a missing feature
value goes left.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.functions.keys import hex_number, keyed_hash
from almanac.operators.quantiles import equi_depth_bounds
from almanac.staging import stage

# Forest size.
TREES, DEPTH, SEED = 3, 4, 15

# Bins of a feature; labels are counted in this part of one.
BINS = 32
LABEL_UNIT = 1 << 20

# Draws of a Poisson distribution with mean 1: a row with a hash of at least the k-th bound counts k times and more.
HASH_SPACE = 1 << 32
DRAWS = [round(HASH_SPACE * sum(math.exp(-1) / math.factorial(i) for i in range(k))) for k in range(1, 9)]

TREE_SCHEMA = "tree int, node int, feature string, threshold double, n bigint, mean double"


@dataclass(frozen=True)
class Node:
    """``feature`` and ``place`` (of the threshold) are None in a leaf; children have numbers 2i and 2i + 1."""

    n: int
    total: int
    feature: int | None = None
    place: int | None = None

    @property
    def mean(self) -> float:
        return self.total / self.n / LABEL_UNIT


@dataclass(frozen=True)
class HistogramForest:
    features: tuple[str, ...]
    thresholds: list[list[float]]
    depth: int
    trees: list[dict[int, Node]] = field(default_factory=list)

    def rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, n, mean) of all nodes."""
        return [
            (
                t, number, None if node.feature is None else self.features[node.feature],
                None if node.feature is None else self.thresholds[node.feature][node.place], node.n, node.mean,
            )
            for t, tree in enumerate(self.trees) for number, node in sorted(tree.items())
        ]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), TREE_SCHEMA)

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the mean of the trees' leaves."""
        values = F.array(*[F.col(f).cast("double") for f in self.features])
        leaves = [_route(tree, self.depth, lambda f, at: F.get(values, f) > F.get(F.get(self._cuts(), f), at)) for tree in self.trees]
        means = [
            F.get(F.array(*[F.lit(tree[i].mean if i in tree else 0.0) for i in range(1 << (self.depth + 1))]), leaf)
            for tree, leaf in zip(self.trees, leaves, strict=True)
        ]
        total = means[0]
        for mean in means[1:]:
            total = total + mean
        return df.withColumn(name, total / len(means))

    def _cuts(self) -> Column:
        return F.array(*[F.array(*map(F.lit, cuts)).cast("array<double>") for cuts in self.thresholds])


def _route(tree: dict[int, Node], levels: int, beyond) -> Column:
    """Number of the node that a row reaches; ``beyond(feature, place)`` says whether it goes right."""
    numbers = range(1 << (levels + 1))
    features = F.array(*[F.lit(tree[i].feature if i in tree else None).cast("int") for i in numbers])
    places = F.array(*[F.lit(tree[i].place if i in tree else None).cast("int") for i in numbers])

    def step(node: Column, _: Column) -> Column:
        right = F.coalesce(beyond(F.get(features, node), F.get(places, node)), F.lit(False)).cast("int")
        return F.when(F.get(features, node).isNull(), node).otherwise(2 * node + right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step) if levels else F.lit(1)


def looked_at(seed: int, tree: int, node: int, features: int) -> list[int]:
    """The features among which a node may choose."""
    drawn = sorted(range(features), key=lambda f: hashlib.md5(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest())
    return sorted(drawn[: -(-features // 3)])


def fit_histogram_forest(
    train: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
    trees: int = TREES, depth: int = DEPTH, seed: int = SEED, bins: int = BINS,
) -> HistogramForest:
    """``key`` must be unique for each row; it decides how often a row counts in a tree."""
    usable = train.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    for column in key:
        usable = usable.where(F.col(column).isNotNull())
    values = [F.col(f).cast("double") for f in features]
    kept = stage(
        usable.select(
            F.array(*values).alias("x"), F.round(F.col(label).cast("double") * LABEL_UNIT).cast("bigint").alias("y"),
            F.array(*[_times(hex_number(keyed_hash(seed, F.lit(t), *key), 8)) for t in range(trees)]).alias("times"),
        ),
        "forest-rows",
    )
    bounds = equi_depth_bounds(kept.select(F.posexplode("x").alias("group", "x")), bins)
    greatest = kept.agg(*[F.max(F.get("x", F.lit(f))).alias(f"f{f}") for f in range(len(features))]).first()
    thresholds = [sorted({b for b in bounds.get(f, []) if b < greatest[f"f{f}"]}) for f in range(len(features))]
    places = [_place(F.get("x", F.lit(f)), cuts) for f, cuts in enumerate(thresholds)]
    binned = stage(kept.select("y", "times", F.array(*places).alias("bins")), "forest-bins")
    forest = HistogramForest(tuple(features), thresholds, depth, [{} for _ in range(trees)])
    for r in _totals(binned).collect():
        forest.trees[r["tree"]][1] = Node(r["n"], int(r["total"]))
    if not all(forest.trees):
        raise ValueError("no training rows")
    for level in range(depth):
        found = _best_splits(binned, forest, level, seed).collect()
        for r in found:
            tree, number = forest.trees[r["tree"]], r["node"]
            before = tree[number]
            tree[number] = Node(before.n, before.total, r["feature"], r["bin"])
            tree[2 * number] = Node(r["left_n"], int(r["left_total"]))
            tree[2 * number + 1] = Node(before.n - r["left_n"], before.total - int(r["left_total"]))
        if not found:
            break
    return forest


def _place(x: Column, cuts: list[float]) -> Column:
    """Thresholds below ``x``, none if it is missing."""
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut < x)), F.lit(0))


def _times(draw: Column) -> Column:
    times = F.lit(0)
    for bound in DRAWS:
        times = times + (draw >= bound).cast("int")
    return times


def _weights(binned: DataFrame, *columns: Column) -> DataFrame:
    return binned.select(F.posexplode("times").alias("tree", "w"), "y", "bins", *columns).where("w > 0")


def _sums() -> list[Column]:
    return [F.sum("w").alias("n"), F.sum(F.col("w").cast("decimal(10,0)") * F.col("y").cast("decimal(19,0)")).cast("decimal(38,0)").alias("total")]


def _totals(binned: DataFrame) -> DataFrame:
    return _weights(binned).groupBy("tree").agg(*_sums())


def _best_splits(binned: DataFrame, forest: HistogramForest, level: int, seed: int) -> DataFrame:
    """(tree, node, feature, bin, left_n, left_total) of the open nodes that a split improves."""
    first, width = 1 << level, len(forest.features)
    bins = F.col("bins")
    nodes = F.array(*[_route(tree, level, lambda f, at: F.get(bins, f) > at) for tree in forest.trees])
    choices = F.array(*[
        F.array(*[
            F.array(*map(F.lit, looked_at(seed, t, node, width) if node in tree else [])).cast("array<int>")
            for node in range(first, 2 * first)
        ])
        for t, tree in enumerate(forest.trees)
    ])
    rows = (
        _weights(binned, nodes.alias("nodes"))
        .withColumn("node", F.get("nodes", F.col("tree")))
        .where(F.col("node") >= first)
        .select("tree", "node", "w", "y", "bins", F.explode(F.get(F.get(choices, F.col("tree")), F.col("node") - first)).alias("feature"))
    )
    histogram = rows.groupBy("tree", "node", "feature", F.get("bins", F.col("feature")).alias("bin")).agg(*_sums())
    upto = Window.partitionBy("tree", "node", "feature").orderBy("bin")
    whole = Window.partitionBy("tree", "node", "feature")
    summed = histogram.select(
        "tree", "node", "feature", "bin", F.sum("n").over(upto).alias("left_n"),
        F.sum("total").over(upto).cast("decimal(38,0)").alias("left_total"),
        F.sum("n").over(whole).alias("n"), F.sum("total").over(whole).cast("decimal(38,0)").alias("total"),
    ).where("left_n < n")
    left, every = F.col("left_total").cast("double"), F.col("total").cast("double")
    right = (F.col("total") - F.col("left_total")).cast("double")
    score = left * left / F.col("left_n") + right * right / (F.col("n") - F.col("left_n"))
    kept = F.struct("feature", "bin", "left_n", "left_total")
    return (
        summed.withColumn("score", score).where(F.col("score") > every * every / F.col("n"))
        .groupBy("tree", "node")
        .agg(F.max_by(kept, F.struct("score", -F.col("feature"), -F.col("bin"))).alias("best"))
        .select("tree", "node", "best.*")
    )
