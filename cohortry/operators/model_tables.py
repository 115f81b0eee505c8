"""Fitted models as tables, and scores from such tables by column expressions.

A table holds all that scoring needs, so a model can be stored, read by any engine and
applied without the library that fitted it. Tables are bounded by the model's settings
(trees, depth, features, clusters) and not by the data; ``MAX_ROWS`` is checked all the same,
since a table travels to every task.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.sources.scratch import scratch_path

MAX_ROWS = 1_000_000
INTERCEPT = "(intercept)"
NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, weight double, link string"


def logistic(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def _checked(table: DataFrame) -> list:
    rows = table.limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"a model table has at most {MAX_ROWS} rows")
    return rows


# --- trees ------------------------------------------------------------------------------


def node_table(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted tree, forest or boosted trees: columns of ``NODES``.

    A row goes left if its feature (a position in the vector, from 0) is at most the threshold; a leaf has
    neither child (-1). A leaf's value counts with its tree's weight, and the sum goes through ``link``: ``identity`` for the share of
    positives in a leaf, averaged over the trees, ``logistic2`` (the logistic function of twice the sum) for boosted trees.
    """
    path = scratch_path(spark, "model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.withColumn("tree", F.lit(0))
    weights = list(getattr(model, "treeWeights", [1.0]))
    boosted = model.__class__.__name__.startswith("GBT")
    if boosted:
        value, link = F.col("prediction"), "logistic2"
        weight = F.element_at(F.array(*map(F.lit, weights)), F.col("tree") + 1)
    else:
        stats = F.col("impurityStats")
        value, link = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, b: a + b), "identity"
        weight = F.lit(1.0 / len(weights))
    return nodes.select(
        "tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), value.alias("value"), weight.alias("weight"), F.lit(link).alias("link"),
    )


def _depth(rows: list) -> int:
    children = {(r["tree"], r["node"]): (r["left"], r["right"]) for r in rows}
    depth, level = 0, [key for key in children if key[1] == 0]
    while level := [(tree, c) for tree, node in level for c in children[tree, node] if c >= 0]:
        depth += 1
    return depth


def score_nodes(df: DataFrame, nodes: DataFrame, features: str | list[str], out: str) -> DataFrame:
    """Add the score of a node table. ``features`` is a vector or array column, or the columns in order.

    The table is packed into one value of arrays, which every task gets; a row walks down each tree inside an expression, so
    nothing is shuffled or joined. A null or NaN feature goes right, as Spark ML sends NaN. Node numbers of a tree run from 0 (the root).
    """
    rows = _checked(nodes)
    if not rows:
        raise ValueError("a node table needs a tree")
    node = F.struct("node", "feature", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"), F.first("weight").alias("weight"))
    packed = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()
    if isinstance(features, list):
        x = F.array(*[F.col(c).cast("double") for c in features])
    else:
        x = F.col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(features)
    steps = F.sequence(F.lit(1), F.lit(max(1, _depth(rows))))

    def value(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = tree["nodes"][at]
            goes_left = F.coalesce(F.get(F.col("__x"), here["feature"]) <= here["threshold"], F.lit(False))
            return F.when(here["left"] < 0, at).when(goes_left, here["left"]).otherwise(here["right"])

        return F.aggregate(steps, F.lit(0), step, lambda leaf: tree["nodes"][leaf]["value"] * tree["weight"])

    total = F.aggregate("__model", F.lit(0.0), lambda sum_, tree: sum_ + value(tree))
    score = logistic(2.0 * total) if rows[0]["link"] == "logistic2" else total
    return df.withColumns({"__x": x, "__model": packed}).withColumn(out, score).select(*df.columns, out)


# --- linear models ----------------------------------------------------------------------


def coefficient_table(spark: SparkSession, model, features: list[str]) -> DataFrame:
    """``feature, coefficient`` of a fitted logistic regression, with the intercept under its own name."""
    rows = [(c, float(w)) for c, w in zip(features, model.coefficients.toArray())]
    return spark.createDataFrame([*rows, (INTERCEPT, float(model.intercept))], "feature string, coefficient double")


def score_linear(df: DataFrame, coefficients: DataFrame, out: str) -> DataFrame:
    """Add the logistic score of a coefficient table over columns of its features' names; null if one is null."""
    margin = F.lit(0.0)
    for r in sorted(_checked(coefficients), key=lambda r: r["feature"]):
        term = F.lit(r["coefficient"])
        margin = margin + (term if r["feature"] == INTERCEPT else term * F.col(r["feature"]))
    return df.withColumn(out, logistic(margin))


# --- clusters ---------------------------------------------------------------------------


def centre_table(spark: SparkSession, model) -> DataFrame:
    """``cluster, centre`` of a fitted KMeans."""
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")


def nearest_centre(x: Column, centres: Column) -> Column:
    """The cluster of the least squared distance; the smaller one of equals. ``centres`` is an array of (cluster, centre)."""

    def distance(c: Column) -> Column:
        squares = F.zip_with(x, c["centre"], lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(squares, F.lit(0.0), lambda s, d: s + d).alias("distance"), c["cluster"].alias("cluster"))

    return F.array_min(F.transform(centres, distance))["cluster"]


def assign_clusters(df: DataFrame, centres: DataFrame, features: str | list[str], out: str = "cluster") -> DataFrame:
    """Add the nearest centre's cluster; null for a row with an unknown feature."""
    _checked(centres)
    packed = centres.agg(F.array_sort(F.collect_list(F.struct("cluster", "centre")))).scalar()
    if isinstance(features, list):
        x = F.array(*[F.col(c).cast("double") for c in features])
    else:
        x = F.col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(features)
    known = F.col("__x").isNotNull() & ~F.exists("__x", lambda v: v.isNull() | F.isnan(v))
    placed = df.withColumns({"__x": x, "__model": packed})
    return placed.withColumn(out, F.when(known, nearest_centre(F.col("__x"), F.col("__model")))).select(*df.columns, out)
