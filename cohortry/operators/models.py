"""Weighted classifiers of Spark ML: settings, fitting and one-pass scoring."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.expressions import positive_score
from cohortry.operators.forests import fit_forest
from cohortry.operators.metrics import auc
from cohortry.operators.splitting import apply_weights, class_weights

# The study's model settings.
SETTINGS = {
    "lr": {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.0},
    "dt": {"maxDepth": 4, "minInstancesPerNode": 400},
    "rf": {
        "numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 25,
        "featureSubsetStrategy": "sqrt", "seed": 42,
    },
    "gbt": {"maxIter": 50, "maxDepth": 4, "stepSize": 0.1, "seed": 42},
}

SENSITIVITY_TREES = (50, 200)

# Spark ML keeps a number per row and tree in memory while it fits a forest, and walks every row through every tree. Beyond so
# many numbers a forest is grown from counts (see ``forests``); a task then counts at most so many trees over its rows.
BAG_NUMBERS = 1 << 28
BATCH_TREES = 25

ESTIMATORS = {
    "lr": LogisticRegression,
    "dt": DecisionTreeClassifier,
    "rf": RandomForestClassifier,
    "gbt": GBTClassifier,
}


def classifier(name: str, label: str, features: str = "features", weight: str | None = "class_weight", **override):
    settings = SETTINGS[name] | override
    if weight:
        settings["weightCol"] = weight
    return ESTIMATORS[name](featuresCol=features, labelCol=label, **settings)


def tree_batches(rows: int, trees: int) -> list[int]:
    """Trees of each batch that a forest is fitted in: all at once by Spark ML, or even batches of several trees."""
    if rows * trees <= BAG_NUMBERS:
        return [trees]
    n = -(-trees // BATCH_TREES)
    return [trees // n + (i < trees % n) for i in range(n)]


def fit_one(estimator, rows: DataFrame):
    """Fit a model on persisted rows; a forest over many rows is grown from counts of blocks of them.

    Every tree sees all rows under the same settings, with bootstrap draws and feature subsets of its own, so either way it is
    a forest of as many independent trees.
    """
    if not isinstance(estimator, RandomForestClassifier):
        return estimator.fit(rows)
    batches = tree_batches(rows.count(), estimator.getNumTrees())
    return estimator.fit(rows) if len(batches) == 1 else fit_forest(estimator, rows, batches)


def fit_classifiers(
    train: DataFrame,
    label: str,
    names: tuple[str, ...] = ("lr", "dt", "rf", "gbt"),
    features: str = "features",
    weight_mode: str = "balanced",
    overrides: dict[str, dict] | None = None,
) -> dict:
    """Fit each model on the weighted training part; weights come from that part only.

    The narrow input (features, label, weight) is persisted for the iterations, on disk
    where memory runs out, and released afterwards. Lost blocks are recomputed.
    """
    weights = class_weights(train, label, weight_mode)
    narrow = apply_weights(train.select(features, label), weights, label)
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {
            name: fit_one(classifier(name, label, features, **(overrides or {}).get(name, {})), narrow)
            for name in names
        }
    finally:
        narrow.unpersist()


def score_models(df: DataFrame, models: dict) -> DataFrame:
    """Scores and predictions of all models in one pass: ``<name>_score``, ``<name>_prediction``.

    With every prediction in one table, later comparisons need no join on the key.
    """
    out = df
    for name, model in models.items():
        model = model.copy()
        model.setPredictionCol(f"{name}_prediction")
        model.setProbabilityCol("_probability")
        model.setRawPredictionCol("_raw")
        scored = model.transform(out)
        out = scored.withColumn(f"{name}_score", positive_score("_probability")).drop("_probability", "_raw")
    return out


def forest_sensitivity(
    train: DataFrame,
    test: DataFrame,
    label: str,
    trees: tuple[int, ...] = SENSITIVITY_TREES,
    max_depth: int = 8,
    features: str = "features",
) -> DataFrame:
    """Test AUC by number of trees, with ratio weights; one row per forest.

    All forests share the weights and the persisted training rows.
    """
    records = []
    weights = class_weights(train, label, "ratio")
    narrow = apply_weights(train.select(features, label), weights, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for n in trees:
            settings = {"numTrees": n, "maxDepth": max_depth, "minInstancesPerNode": 1, "featureSubsetStrategy": "auto"}
            model = {"rf": fit_one(classifier("rf", label, features, **settings), narrow)}
            scored = score_models(test.select(features, label), model)
            records.append(auc(scored, label, "rf_score").select(F.lit(n).alias("n_trees"), "auc"))
    finally:
        narrow.unpersist()
    return reduce(DataFrame.unionByName, records)
