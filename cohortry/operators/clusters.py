"""KMeans screening, silhouette and cluster profiles."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.sources.scratch import stored

# Candidate numbers of clusters and the seed.
SCREENED_K = (4, 5, 6)
SEED = 42
# Cluster means up to this many doubles (some 40 MB) travel with the scoring function;
# more of them are dealt over tasks in blocks of this size.
BLOCK_NUMBERS = 5_000_000
SLICE_ROWS = 20_000
# Distances a worker holds at a time.
DISTANCES_AT_ONCE = 2_000_000


@dataclass(frozen=True)
class Screening:
    """``k, silhouette`` per candidate, and the fitted models by k."""

    table: DataFrame
    models: dict[int, KMeansModel]


def kmeans(k: int, features: str = "features", seed: int = SEED) -> KMeans:
    return KMeans(featuresCol=features, predictionCol="cluster", k=k, seed=seed)


def screen(df: DataFrame, ks: tuple[int, ...] = SCREENED_K, features: str = "features", seed: int = SEED) -> Screening:
    """Fit every candidate and score them all in one pass; class weights play no part."""
    vectors = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {k: kmeans(k, features, seed).fit(vectors) for k in ks}
        assigned = vectors
        for k, model in models.items():
            assigned = model.transform(assigned, {model.predictionCol: f"k{k}"})
        names = {k: f"k{k}" for k in ks}
        points = assigned.select(F.col(features).alias("x"), *[F.col(c).cast("string").alias(c) for c in names.values()])
        row = {r["by"]: r["silhouette"] for r in _scores(points, _summaries(points, list(names.values())), list(names.values())).collect()}
    finally:
        vectors.unpersist()
    table = df.sparkSession.createDataFrame([(k, row[c]) for k, c in names.items()], "k int, silhouette double")
    return Screening(table, models)


def screen_k(
    df: DataFrame, ks: tuple[int, ...] = SCREENED_K, features: str = "features", seed: int = SEED
) -> DataFrame:
    """``k, silhouette`` per candidate."""
    return screen(df, ks, features, seed).table


def fit_clusters(df: DataFrame, k: int, features: str = "features", seed: int = SEED) -> DataFrame:
    """The table with its ``cluster``, after a fit on the same rows."""
    vectors = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = kmeans(k, features, seed).fit(vectors)
    finally:
        vectors.unpersist()
    return model.transform(df)


def cluster_profile(df: DataFrame, cluster: str, columns: list[str], label: str) -> DataFrame:
    """Size, mean of each (unscaled) column and positive prevalence per cluster."""
    return df.groupBy(cluster).agg(
        F.count("*").alias("n_rows"),
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        F.avg(label).alias("prevalence"),
    )


def _summaries(points: DataFrame, columns: list[str]) -> DataFrame:
    """``by, cluster, count, total, norms`` for every column of clusters, in one aggregation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("by"), F.col(c).alias("cluster")) for c in columns])
    metrics = Summarizer.metrics("count", "sum", "normL2").summary(F.col("x")).alias("m")
    long = points.select("x", F.explode(pairs).alias("p")).select("x", "p.by", "p.cluster")
    return long.groupBy("by", "cluster").agg(metrics).select(
        "by", "cluster", "m.count", vector_to_array("m.sum").alias("total"), vector_to_array("m.normL2").alias("norms")
    )


def _scores(points: DataFrame, summary: DataFrame, columns: list[str]) -> DataFrame:
    """``by, n_rows, silhouette`` of every column of clusters. The summaries, of checked size, are broadcast as one row each."""
    add = lambda s, v: s + v
    mean = F.transform("total", lambda t: t / F.col("count"))
    spread = F.aggregate(F.transform("norms", lambda n: n * n), F.lit(0.0), add) / F.col("count")
    packed = summary.select("by", F.struct("cluster", F.col("count").cast("double").alias("count"), mean.alias("mean"), spread.alias("spread")).alias("c"))
    packed = packed.groupBy("by").agg(F.collect_list("c").alias("clusters"))
    pairs = F.array(*[F.struct(F.lit(c).alias("by"), F.col(c).alias("own")) for c in columns])
    long = points.select(vector_to_array("x").alias("x"), F.explode(pairs).alias("p")).select("x", "p.by", "p.own")
    long = long.withColumn("square", F.aggregate(F.transform("x", lambda v: v * v), F.lit(0.0), add)).join(F.broadcast(packed), "by")

    def distance(c: Column) -> Column:
        product = F.aggregate(F.zip_with("x", c["mean"], lambda a, b: a * b), F.lit(0.0), add)
        return F.struct(c["cluster"].alias("cluster"), c["count"].alias("count"), (F.col("square") + c["spread"] - 2.0 * product).alias("d"))

    met = long.select("by", "own", F.transform("clusters", distance).alias("ds"))
    own = F.filter("ds", lambda c: c["cluster"] == F.col("own"))[0]
    others = F.filter("ds", lambda c: c["cluster"] != F.col("own"))
    parts = met.select("by", own["count"].alias("size"), own["d"].alias("d"), F.array_min(F.transform(others, lambda c: c["d"])).alias("outer"))
    inner = F.col("d") * F.col("size") / F.greatest(F.col("size") - 1.0, F.lit(1.0))
    larger = F.greatest(inner, F.col("outer"))
    value = F.when((F.col("size") > 1) & (larger > 0), (F.col("outer") - inner) / larger).otherwise(0.0)
    return parts.groupBy("by").agg(F.count("*").alias("n_rows"), F.avg(value).alias("silhouette"))


class _Clusters:
    """Sizes, means and mean squared norms of some clusters, for tables of clusters too long to broadcast."""

    def __init__(self, names, counts, totals, norms):
        self.names = pd.Index(names)
        self.counts = np.asarray(counts, dtype=float)
        self.means = np.stack(list(totals)) / self.counts[:, None]
        self.spread = np.array([np.square(n).sum() for n in norms]) / self.counts

    def distances(self, x: np.ndarray, cluster) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean squared distance to the own cluster's others, its size, and the least to another.

        A cluster that is not among these has size 0 and distance 0.
        """
        parts = []
        own_of = self.names.get_indexer(cluster)
        step = max(1, DISTANCES_AT_ONCE // len(self.counts))
        for i in range(0, len(x), step):
            rows, own = x[i : i + step], own_of[i : i + step]
            distance = np.square(rows).sum(axis=1)[:, None] + self.spread - 2.0 * rows @ self.means.T
            here = np.flatnonzero(own >= 0)
            size, inner = np.zeros(len(rows)), np.zeros(len(rows))
            size[here] = self.counts[own[here]]
            inner[here] = distance[here, own[here]] * size[here] / np.maximum(size[here] - 1.0, 1.0)
            distance[here, own[here]] = np.inf
            parts.append((inner, size, distance.min(axis=1)))
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0),) * 3


def silhouette(df: DataFrame, features: str, cluster: str, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """Mean silhouette under squared Euclidean distance; a singleton cluster scores 0.

    The mean squared distance of x to a cluster follows from the cluster's count, vector
    sum and sum of squared norms, so the work is one aggregation and one pass: no pair of
    rows is ever formed. Rows without a cluster or a whole vector take no part;
    ``n_rows`` counts those that do.
    """
    if isinstance(df.schema[features].dataType, T.ArrayType):
        whole = F.col(features).isNotNull() & ~F.exists(features, F.isnull)
        vector = array_to_vector(F.col(features).cast("array<double>"))
    else:
        whole, vector = F.col(features).isNotNull(), F.col(features)
    known = df.where(whole & F.col(cluster).isNotNull())
    points = known.select(vector.alias("x"), F.col(cluster).cast("string").alias("cluster"))
    summary = _summaries(points, ["cluster"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, width = summary.agg(F.count("*"), F.max(F.size("total"))).first()
        if n < 2:
            raise ValueError("a silhouette needs at least two clusters")
        if n * width > block_numbers:
            return _silhouette_by_blocks(points, stored(summary, "clusters"), math.ceil(n * width / block_numbers))
        # The result is one row: it is computed while the summary is held.
        row = _scores(points, summary, ["cluster"]).first()
    finally:
        summary.unpersist()
    return df.sparkSession.createDataFrame([(row["n_rows"], row["silhouette"])], "n_rows bigint, silhouette double")


def _silhouette_by_blocks(points: DataFrame, summary: DataFrame, blocks: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The same for more clusters than travel at once: slices of distinct rows meet blocks of clusters in tasks."""
    distinct = points.select("cluster", vector_to_array("x").alias("x")).groupBy("cluster", "x").agg(F.count("*").alias("n"))
    slices = max(1, math.ceil(points.count() / slice_rows))
    upto: Column = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = distinct.withColumn("slice", F.pmod(F.xxhash64("cluster", "x"), F.lit(slices)).cast("int")).withColumn("block", upto(blocks))
    right = summary.withColumn("block", F.pmod(F.xxhash64("cluster"), F.lit(blocks)).cast("int")).withColumn("slice", upto(slices))

    def compare(rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out = rows[["cluster", "x", "n"]]
        if rows.empty or some.empty:
            return out.iloc[:0].assign(inner=0.0, size=0.0, outer=0.0)
        near = _Clusters(some["cluster"], some["count"], some["total"], some["norms"])
        inner, size, outer = near.distances(np.stack(rows["x"].to_numpy()), rows["cluster"])
        return out.assign(inner=inner, size=size, outer=outer)

    met = left.groupBy("slice", "block").cogroup(right.groupBy("slice", "block")).applyInPandas(
        compare, "cluster string, x array<double>, n bigint, inner double, size double, outer double"
    )
    found = met.groupBy("cluster", "x").agg(
        F.any_value("n").alias("n"), F.max("size").alias("size"), F.max_by("inner", "size").alias("inner"), F.min("outer").alias("outer")
    )
    larger = F.greatest("inner", "outer")
    value = F.when((F.col("size") > 1) & (larger > 0), (F.col("outer") - F.col("inner")) / larger).otherwise(0.0)
    return found.agg(F.sum("n").alias("n_rows"), (F.sum(value * F.col("n")) / F.sum("n")).alias("silhouette"))
