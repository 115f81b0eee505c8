"""Random forests over many rows: the forest of Spark ML, grown level by level from counts of binned rows.

Spark ML keeps a number per row and tree and walks every row through every tree, drawn or not, an object at a time. Here the
rows are binned once into stored blocks of bytes. One pass per level counts, for every tree, the drawn rows of a block by node,
feature, bin and class as arrays, one shuffle adds the counts up by tree, and the best split of each node goes to the driver.
Settings, bootstrap, candidate splits, feature subsets, stopping rules and merging of equal leaves are Spark ML's, and so is the model.
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.sources.scratch import scratch_path, stored

# Tasks get the functions below by value, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block: its bins and the arrays of a tree's walk stay in a core's cache.
BLOCK_ROWS = 1 << 14
# Rows whose blocks one task holds, and nodes of a tree whose counts it holds; a wider level takes several passes.
TASK_ROWS = 1 << 20
PASS_NODES = 1 << 11
# Spark ML takes the candidate splits from so many rows, or the square of the bins.
CANDIDATE_ROWS = 10_000

BLOCKS = "n int, bins binary, classes binary"
COUNTS = "tree int, counts binary"
SPLITS = "tree int, slot int, feature int, cut int, gain double, own array<bigint>, lower array<bigint>"
NODE_DATA = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


@dataclass(frozen=True)
class Rules:
    """What the passes need of the estimator's settings."""

    seed: int
    bins: int
    subset: int
    weights: tuple[float, ...]
    impurity: str
    min_rows: int
    min_weight: float
    min_gain: float
    bootstrap: bool
    rate: float

    @property
    def bin_type(self) -> type:
        return np.uint8 if self.bins <= 256 else np.uint16 if self.bins <= 1 << 16 else np.uint32

    @property
    def cell_type(self) -> np.dtype:
        """Of a bin and class in one number, ``bin * classes + class``."""
        return np.min_scalar_type(self.bins * len(self.weights) - 1)


@dataclass
class Tree:
    """Nodes in the order they were made; children are neighbours, and a leaf leads to itself."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    counts: list[list[int]] = field(default_factory=lambda: [[]])

    def split(self, node: int, feature: int, cut: int, gain: float, sides: tuple[list[int], list[int]]) -> tuple[int, int]:
        first = len(self.left)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for child, counts in zip((first, first + 1), sides):
            self.feature.append(0)
            self.cut.append(-1)
            self.left.append(child)
            self.gain.append(-1.0)
            self.counts.append(counts)
        return first, first + 1

    def arrays(self, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, last cells below the cuts and left children of the nodes."""
        last, n_classes = np.iinfo(rules.cell_type).max, len(rules.weights)  # no cell lies above it, so a leaf's rows stay
        cut = np.array([last if c < 0 else (c + 1) * n_classes - 1 for c in self.cut], rules.cell_type)
        return np.array(self.feature, np.intp), cut, np.array(self.left, np.intp)


def subset_size(strategy: str, trees: int, features: int) -> int:
    """Features tried at a node, as Spark ML reads ``featureSubsetStrategy`` of a classifier."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {
        "all": features, "sqrt": math.ceil(math.sqrt(features)),
        "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3),
    }
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


def impurity(weighted: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy of class weights along the last axis."""
    total = weighted.sum(-1, keepdims=True)
    share = np.divide(weighted, total, out=np.zeros_like(weighted), where=total > 0)
    if kind == "gini":
        return 1.0 - (share * share).sum(-1)
    return -(share * np.log2(share, out=np.zeros_like(share), where=share > 0)).sum(-1)


def candidate_splits(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Thresholds of one feature: between all its values, or at most so many about as many rows apart."""
    found, where = np.unique(values, return_inverse=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= most:
        return between
    counts = np.bincount(where, weights)
    stride = counts.sum() / (most + 1)
    splits, seen, target = [], counts[0], stride
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            splits.append(between[i - 1])
            target += stride
    return np.array(splits)


def _blocks(df: DataFrame, thresholds: list[np.ndarray], bin_type: type, n_rows: int) -> DataFrame:
    """Rows of ``x``, ``y`` as stored blocks of bins and classes, dealt evenly, with an id."""
    width = len(thresholds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(bins: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([len(classes)], pa.int32()), pa.array([bins.tobytes()], pa.binary()), pa.array([classes.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["n", "bins", "classes"])

        bins, classes = np.empty((0, width), bin_type), np.empty(0, np.uint8)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if x.size != batch.num_rows * width or not np.isfinite(x).all():
                raise ValueError("features must be whole vectors of finite numbers")
            x = x.reshape(-1, width)
            new = np.stack([np.searchsorted(t, x[:, i]) for i, t in enumerate(thresholds)], 1).astype(bin_type)
            bins = np.concatenate([bins, new])
            classes = np.concatenate([classes, batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)])
            while len(classes) >= BLOCK_ROWS:
                yield block(bins[:BLOCK_ROWS], classes[:BLOCK_ROWS])
                bins, classes = bins[BLOCK_ROWS:], classes[BLOCK_ROWS:]
        if len(classes):
            yield block(bins, classes)

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // TASK_ROWS))
    # Numbered before they are dealt: a block's draws go by its number, so a refit on the same rows agrees.
    blocks = df.mapInArrow(pack, BLOCKS).withColumn("id", F.monotonically_increasing_id())
    return stored(blocks.repartition(tasks), "blocks")


def _drawn(rng: np.random.Generator, n: int, rules: Rules) -> np.ndarray:
    """How often a tree draws each row of a block."""
    if rules.bootstrap:  # a Poisson number of uniform draws: independent Poisson counts per row
        return np.bincount(rng.integers(0, n, rng.poisson(n * rules.rate), dtype=np.uint32), minlength=n)
    return np.ones(n, np.intp) if rules.rate == 1 else (rng.random(n) < rules.rate).astype(np.intp)


def _cells(bins: bytes, classes: bytes, rules: Rules) -> np.ndarray:
    """Bin and class of a block's rows in one number, feature by feature, so that a feature's rows lie side by side."""
    of_class = np.frombuffer(classes, np.uint8)
    by_feature = np.frombuffer(bins, rules.bin_type).reshape(len(of_class), -1).T
    return (by_feature.astype(rules.cell_type) * rules.cell_type.type(len(rules.weights)) + of_class).astype(rules.cell_type).ravel()


def _tree_counts(tree: int, blocks: list, grown: tuple, level: int, slots: np.ndarray, tried: np.ndarray, rules: Rules) -> np.ndarray:
    """Drawn rows by tried feature, slot, bin and class. ``slots``: place of a node in this pass, or -1."""
    feature, cut, left = grown
    n_slots, width = len(tried), rules.bins * len(rules.weights)
    counts = np.zeros((tried.shape[1], n_slots * width))
    partial = slots.min() < 0
    for block, n, cells in blocks:
        rng = np.random.Generator(np.random.SFC64([rules.seed, tree, block]))
        times = _drawn(rng, n, rules)
        rows = np.flatnonzero(times > 0)
        start = feature * n
        node = np.zeros(len(rows), np.intp)
        for _ in range(level):
            above = cells.take(start.take(node) + rows) > cut.take(node)
            node = left.take(node) + above
        slot = slots.take(node)
        if partial:
            kept = np.flatnonzero(slot >= 0)
            rows, slot = rows.take(kept), slot.take(kept)
        weight = times.take(rows).astype(float)
        base, starts = slot * width, tried * n
        for j in range(tried.shape[1]):
            cell = base + cells.take(starts[:, j].take(slot) + rows)
            counts[j] += np.bincount(cell, weight, minlength=n_slots * width)
    return counts


def _count_pass(grown: list, level: int, slots: list, tried: list, batch_of: np.ndarray, rules: Rules):
    """Counts of the trees of a task's batch over its blocks, one row per tree."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part in batches:
            for row in part.to_pylist():
                held.setdefault(row["batch"], []).append((row["id"], row["n"], _cells(row["bins"], row["classes"], rules)))
        for batch, blocks in held.items():
            for tree in np.flatnonzero(batch_of == batch).tolist():
                if len(tried[tree]):
                    counts = _tree_counts(tree, blocks, grown[tree], level, slots[tree], tried[tree], rules)
                    columns = [pa.array([tree], pa.int32()), pa.array([counts.astype(np.int64).tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "counts"])

    return count


def _best_splits(tried: list, rules: Rules):
    """The best split of each of a tree's nodes in this pass; feature -1 where no split is allowed."""

    def best(parts: pd.DataFrame) -> pd.DataFrame:
        tree, weights = int(parts["tree"].iloc[0]), np.array(rules.weights)
        summed = np.zeros(len(np.frombuffer(parts["counts"].iloc[0], np.int64)), np.int64)
        for counts in parts["counts"]:
            summed += np.frombuffer(counts, np.int64)
        slots, k = tried[tree].shape
        lower = summed.reshape(k, slots, rules.bins, len(weights)).cumsum(2)
        own = lower[0, :, -1]
        lower = lower[:, :, :-1]
        upper = own[None, :, None] - lower
        whole, below, above = own * weights, lower * weights, upper * weights
        share = below.sum(-1) / np.maximum(whole.sum(-1), np.finfo(float).tiny)[None, :, None]
        gain = impurity(whole, rules.impurity)[None, :, None]
        gain = gain - share * impurity(below, rules.impurity) - (1 - share) * impurity(above, rules.impurity)
        allowed = (np.minimum(lower.sum(-1), upper.sum(-1)) >= max(rules.min_rows, 1)) & (gain >= rules.min_gain) & (gain > 0)
        allowed &= np.minimum(below.sum(-1), above.sum(-1)) >= rules.min_weight
        gain = np.where(allowed, gain, -1.0).transpose(1, 0, 2).reshape(slots, -1)
        place = gain.argmax(1)
        j, cut = np.divmod(place, rules.bins - 1)
        i = np.arange(slots)
        gain = gain[i, place]
        return pd.DataFrame({
            "tree": tree, "slot": i, "feature": np.where(gain > 0, tried[tree][i, j], -1), "cut": cut, "gain": gain,
            "own": list(own), "lower": list(lower[j, i, cut]),
        })

    return best


def grow(blocks: DataFrame, batches: list[int], depth: int, n_features: int, rules: Rules) -> list[Tree]:
    """Trees grown a level at a time. A task counts one batch of trees over some blocks; the driver holds nodes only."""
    batch_of = np.repeat(np.arange(len(batches)), batches)
    by_batch = reduce(DataFrame.unionByName, [blocks.withColumn("batch", F.lit(i)) for i in range(len(batches))])
    trees = [Tree() for _ in batch_of]
    active: list[list[int]] = [[0] for _ in trees]
    for level in range(max(depth, 1)):
        grown = [t.arrays(rules) for t in trees]
        following: list[list[int]] = [[] for _ in trees]
        for start in range(0, max(map(len, active)), PASS_NODES):
            nodes = [a[start : start + PASS_NODES] for a in active]
            slots, tried = [], []
            for t, taken in enumerate(nodes):
                slot = np.full(len(trees[t].left), -1, np.intp)
                slot[taken] = np.arange(len(taken))
                slots.append(slot)
                order = np.random.default_rng([rules.seed, t, level, start]).random((len(taken), n_features)).argsort(1)
                tried.append(order[:, : rules.subset])
            counts = by_batch.mapInArrow(_count_pass(grown, level, slots, tried, batch_of, rules), COUNTS)
            splits = counts.groupBy("tree").applyInPandas(_best_splits(tried, rules), SPLITS)
            for r in sorted(splits.collect(), key=lambda r: (r["tree"], r["slot"])):
                tree, node = trees[r["tree"]], nodes[r["tree"]][r["slot"]]
                tree.counts[node] = r["own"]
                if r["feature"] < 0 or level == depth:
                    continue
                sides = (r["lower"], [a - b for a, b in zip(r["own"], r["lower"])])
                for child, side in zip(tree.split(node, r["feature"], r["cut"], r["gain"], sides), sides):
                    if impurity(np.array(side) * rules.weights, rules.impurity) >= np.finfo(float).eps:
                        following[r["tree"]].append(child)
        active = following
        if not any(active):
            break
    return trees


def node_rows(tree: Tree, thresholds: list[np.ndarray], rules: Rules) -> list[tuple]:
    """Nodes as Spark ML stores them, numbered from the root; sibling leaves of one prediction are merged, as it does."""
    weighted = np.array(tree.counts) * rules.weights
    predicted, impure = weighted.argmax(1), impurity(weighted, rules.impurity)
    leaf = [left == node for node, left in enumerate(tree.left)]
    for node in reversed(range(len(leaf))):
        left = tree.left[node]
        if not leaf[node] and leaf[left] and leaf[left + 1] and predicted[left] == predicted[left + 1]:
            leaf[node] = True
    number, stack = {}, [0]
    while stack:
        node = stack.pop()
        number[node] = len(number)
        if not leaf[node]:
            stack += [tree.left[node] + 1, tree.left[node]]
    rows = []
    for node, i in number.items():
        stats = (i, float(predicted[node]), float(impure[node]), weighted[node].tolist(), int(sum(tree.counts[node])))
        if leaf[node]:
            rows.append((*stats, -1.0, -1, -1, (-1, [], -1)))
        else:
            left, feature = tree.left[node], tree.feature[node]
            split = (feature, [float(thresholds[feature][tree.cut[node]])], -1)
            rows.append((*stats, float(tree.gain[node]), number[left], number[left + 1], split))
    return rows


def forest_model(estimator, df: DataFrame, trees: list[Tree], thresholds: list[np.ndarray], rules: Rules) -> RandomForestClassificationModel:
    """The trees as a model of Spark ML, through its stored form."""
    spark = df.sparkSession
    path = scratch_path(spark, "forest")
    package = "org.apache.spark.ml.classification"
    about = {
        "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "paramMap": {"impurity": rules.impurity},
        "defaultParamMap": {}, "numFeatures": len(thresholds), "numClasses": len(rules.weights),
    }
    forest = about | {"class": f"{package}.RandomForestClassificationModel", "uid": estimator.uid, "numTrees": len(trees)}
    kept = [
        (i, json.dumps(about | {"class": f"{package}.DecisionTreeClassificationModel", "uid": f"{estimator.uid}_{i}"}), 1.0)
        for i in range(len(trees))
    ]
    nodes = [(i, row) for i, tree in enumerate(trees) for row in node_rows(tree, thresholds, rules)]
    spark.createDataFrame([(json.dumps(forest),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(kept, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, NODE_DATA).write.parquet(f"{path}/data")
    model = estimator._copyValues(RandomForestClassificationModel.load(path))
    model._transfer_params_to_java()  # the columns and settings, which a saved model states
    return model


def fit_forest(estimator, df: DataFrame, batches: list[int]) -> RandomForestClassificationModel:
    """Fit a ``RandomForestClassifier`` on persisted rows with batches of so many trees as units of work.

    Features are numbers, and a row's weight is that of its class.
    """
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    if "nominal" in df.schema[features].metadata.get("ml_attr", {}).get("attrs", {}):
        raise ValueError("features of many rows must be numbers, not categories")
    weight = F.col(estimator.getWeightCol()).cast("double") if estimator.isSet("weightCol") else F.lit(1.0)
    rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), weight.alias("w"))
    classes = rows.groupBy("y").agg(F.count("*").alias("n"), F.min("w").alias("low"), F.max("w").alias("high")).collect()
    if any(r["y"] not in range(256) or r["low"] is None or not 0 <= r["low"] == r["high"] for r in classes):
        raise ValueError("labels must be class numbers, and weights must belong to classes")
    n_rows, weight_of = sum(r["n"] for r in classes), {int(r["y"]): r["low"] for r in classes}
    total = sum(r["n"] * r["low"] for r in classes)
    wanted = max(estimator.getMaxBins() ** 2, CANDIDATE_ROWS)
    sample = rows.sample(min(1.0, wanted / n_rows), seed=estimator.getSeed()) if wanted < n_rows else rows
    taken = sample.select("x", "w").toPandas()
    values = np.stack(taken["x"].to_list())
    thresholds = [candidate_splits(x, taken["w"].to_numpy(), estimator.getMaxBins() - 1) for x in values.T]
    rules = Rules(
        seed=estimator.getSeed() % (1 << 63),
        bins=max(2, *(len(t) + 1 for t in thresholds)),
        subset=subset_size(estimator.getFeatureSubsetStrategy(), estimator.getNumTrees(), len(thresholds)),
        weights=tuple(weight_of.get(c, 0.0) for c in range(max(max(weight_of) + 1, 2))),
        impurity=estimator.getImpurity(),
        min_rows=estimator.getMinInstancesPerNode(),
        min_weight=estimator.getMinWeightFractionPerNode() * total,
        min_gain=estimator.getMinInfoGain(),
        bootstrap=estimator.getBootstrap(),
        rate=estimator.getSubsamplingRate(),
    )
    blocks = _blocks(rows.select("x", "y"), thresholds, rules.bin_type, n_rows)
    trees = grow(blocks, batches, estimator.getMaxDepth(), len(thresholds), rules)
    return forest_model(estimator, df, trees, thresholds, rules)
