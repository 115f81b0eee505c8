"""Classifiers and clusters on the stand-in table."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortry.operators import clusters, forests, metrics, model_tables, models
from cohortry.plans import registry, study
from cohortry.sources import scratch

SF = "/root/testdata/sf0.01"
LABEL = study.STAND_IN.target


@pytest.fixture(scope="module")
def parts(spark):
    return study.transform(registry.imputed(spark, SF), study.STAND_IN, top=12)


def test_classifiers(parts):
    fitted = models.fit_classifiers(parts.train, LABEL)
    scored = models.score_models(parts.test, fitted).cache()
    assert scored.count() == parts.test.count()
    names = {m: (f"{m}_score", f"{m}_prediction") for m in fitted}
    for score, prediction in names.values():
        low, high = scored.agg(F.min(score), F.max(score)).first()
        assert 0.0 <= low <= high <= 1.0
        assert {r[0] for r in scored.select(prediction).distinct().collect()} <= {0.0, 1.0}
    for record in metrics.compare_models(scored, names, LABEL, study.STAND_IN.key).collect():
        assert record["auc"] > 0.8 and record["reconciles"]
        assert record["top_capture"] > 0.3


def test_classifier_reports(spark):
    recall = registry.QUERIES["classifier_subgroup_recall"](spark, SF).collect()
    overall = next(r for r in recall if r["is_overall"])
    assert overall["lr_tp"] == sum(r["lr_tp"] for r in recall if not r["is_overall"])
    gains = [r["capture"] for r in registry.QUERIES["classifier_gains"](spark, SF).orderBy("depth").collect()]
    assert gains == sorted(gains) and gains[-1] > 0.8
    sweep = registry.QUERIES["classifier_thresholds"](spark, SF).orderBy("threshold").collect()
    assert [r["contacted"] for r in sweep] == sorted((r["contacted"] for r in sweep), reverse=True)


def test_refit_is_the_same(parts):
    runs = []
    for _ in range(2):
        fitted = models.fit_classifiers(parts.train, LABEL, ("dt", "rf"))
        scored = models.score_models(parts.test, fitted)
        runs.append([metrics.auc(scored, LABEL, f"{m}_score").first()["auc"] for m in fitted])
    assert runs[0] == runs[1]


def test_trees_over_many_rows_are_fitted_in_batches(spark, parts, monkeypatch):
    """A number per row and tree must fit in memory; the joined forest has all trees, and its score is their mean."""
    assert models.tree_batches(1_000_000, 200) == [200]
    assert models.tree_batches(30_000_000, 200) == [25] * 8 and models.tree_batches(30_000_000, 51) == [17] * 3
    small = {"rf": {"numTrees": 7, "maxDepth": 4, "minInstancesPerNode": 5}}
    whole = models.fit_classifiers(parts.train, LABEL, ("rf",), overrides=small)
    monkeypatch.setattr(models, "BAG_NUMBERS", 1)
    monkeypatch.setattr(models, "BATCH_TREES", 3)
    fitted = models.fit_classifiers(parts.train, LABEL, ("rf",), overrides=small)
    trees = fitted["rf"].trees
    assert fitted["rf"].getNumTrees == len(trees) == 7
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 7
    scored = models.score_models(parts.test, fitted).cache()
    aucs = [metrics.auc(models.score_models(parts.test, m), LABEL, "rf_score").first()["auc"] for m in (whole, fitted)]
    assert aucs[0] == pytest.approx(aucs[1], abs=0.03)
    table = model_tables.node_table(spark, fitted["rf"])
    assert {r[0] for r in table.select("tree").distinct().collect()} == set(range(7))
    ours = model_tables.score_nodes(scored, table, "features", "ours")
    assert ours.agg(F.max(F.abs(F.col("ours") - F.col("rf_score")))).first()[0] < 1e-9
    assert scored.where((F.col("rf_score") > 0.5) != (F.col("rf_prediction") == 1)).count() == 0


def survey_like(spark, n=3000):
    """Codes, a rare code, copies, a continuous column of many values and a constant one; a weight per class."""
    rng = random.Random(5)
    rows = []
    for _ in range(n):
        x = [rng.randrange(13), rng.gauss(28, 6), float(rng.random() < 0.01), rng.randrange(5), 1.0]
        rows.append((Vectors.dense(x), float(rng.random() < 1 / (1 + math.exp(4 - 0.3 * x[0] - 0.05 * x[1])))))
    df = spark.createDataFrame(rows + rows[:50], ["features", "y"])
    return df.withColumn("w", F.when(F.col("y") == 1, 1.7).otherwise(0.6)).repartition(3).persist()


@pytest.mark.parametrize("settings", [{}, {"impurity": "entropy", "minInfoGain": 0.004, "minWeightFractionPerNode": 0.05}, {"maxDepth": 0}])
def test_counted_tree_is_that_of_spark(spark, settings, monkeypatch):
    """Without draws nothing is random: the same nodes, thresholds and class weights, in blocks and passes of any size."""
    monkeypatch.setattr(forests, "BLOCK_ROWS", 700)
    monkeypatch.setattr(forests, "PASS_NODES", 6)
    df = survey_like(spark)
    settings = {"maxDepth": 6, "minInstancesPerNode": 25, "numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"} | settings
    estimator = models.RandomForestClassifier(labelCol="y", weightCol="w", seed=7, **settings)
    theirs, ours = estimator.fit(df), forests.fit_forest(estimator, df, [1])
    body = lambda m: m.toDebugString.split("\n", 1)[1]
    assert body(ours) == body(theirs)
    assert ours.totalNumNodes == theirs.totalNumNodes and (ours.totalNumNodes > 5 or settings["maxDepth"] == 0)
    pairs = zip(*(m.transform(df.select("features")).select("rawPrediction", "prediction").collect() for m in (theirs, ours)))
    for a, b in pairs:
        assert a["prediction"] == b["prediction"] and a["rawPrediction"].toArray() == pytest.approx(b["rawPrediction"].toArray(), abs=1e-12)
    params = lambda m: {p.name: v for p, v in m.extractParamMap().items()}
    assert params(ours) == params(theirs)


def test_forest_over_many_rows_walks_no_row_through_spark_ml(spark, monkeypatch):
    """Its time grew with Spark ML's walk of every row through every tree, batch by batch."""
    df = survey_like(spark)
    estimator = models.RandomForestClassifier(labelCol="y", weightCol="w", seed=7, numTrees=8, maxDepth=5, minInstancesPerNode=20)
    whole = estimator.fit(df)
    monkeypatch.setattr(models, "BAG_NUMBERS", 1)
    monkeypatch.setattr(models, "BATCH_TREES", 3)
    monkeypatch.setattr(forests, "BLOCK_ROWS", 700)
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda *_: pytest.fail("fitted by Spark ML"))
    forest = models.fit_one(estimator, df)
    assert forest.getNumTrees == 8 and 0.7 < forest.totalNumNodes / whole.totalNumNodes < 1.4
    nodes = {}
    path = scratch.scratch_path(spark, "forest")
    forest.write().save(path)
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes[r["treeID"], r["id"]] = r
    drawn = [nodes[t, 0]["rawCount"] for t in range(8)]
    assert len(set(drawn)) > 1 and all(abs(n - 3050) < 6 * 3050**0.5 for n in drawn)  # Poisson of all rows
    for (tree, _), r in nodes.items():
        assert r["rawCount"] >= 20
        if r["leftChild"] >= 0:
            sides = [nodes[tree, r[side]] for side in ("leftChild", "rightChild")]
            assert sum(s["rawCount"] for s in sides) == r["rawCount"]
            assert [sum(s) for s in zip(*(s["impurityStats"] for s in sides))] == pytest.approx(r["impurityStats"])
    assert models.fit_one(estimator, df).toDebugString == forest.toDebugString


@pytest.mark.parametrize(("bins", "classes"), [(2, 2), (32, 2), (128, 2), (200, 3), (256, 256), (70_000, 2)])
def test_counted_cells_of_any_width(bins, classes):
    """A bin and class share one number, as narrow as they allow; the counts are those of a plain walk, row by row."""
    rng = np.random.default_rng(bins)
    rules = forests.Rules(7, bins, 2, tuple(range(1, classes + 1)), "gini", 1, 0.0, 0.0, True, 0.8)
    tree = forests.Tree()
    tree.split(0, 1, 0, 0.1, ([1], [1]))
    tree.split(2, 2, bins - 2, 0.1, ([1], [1]))
    slots, tried = np.array([-1, 0, -1, 1, -1]), np.array([[0, 2], [1, 0]])
    blocks, wanted = [], np.zeros((2, 2, bins, classes))
    for block, n in enumerate((1, 300)):
        x, y = rng.integers(0, bins, (n, 3)).astype(rules.bin_type), rng.integers(0, classes, n).astype(np.uint8)
        x[: n // 3, 1], x[-1] = 0, bins - 1
        blocks.append((block, n, forests._cells(x.tobytes(), y.tobytes(), rules)))
        times = forests._drawn(np.random.Generator(np.random.SFC64([7, 4, block])), n, rules)
        for row, c, k in zip(x, y, times):
            node = 0
            while tree.left[node] != node:
                node = tree.left[node] + int(row[tree.feature[node]] > tree.cut[node])
            for j, f in enumerate(tried[slots[node]] if slots[node] >= 0 else ()):
                wanted[j, slots[node], row[f], c] += k
    counts = forests._tree_counts(4, blocks, tree.arrays(rules), 2, slots, tried, rules)
    assert wanted.sum() > 100 and (counts == wanted.reshape(2, -1)).all()


def test_features_tried_at_a_node():
    sizes = [forests.subset_size(s, 200, 12) for s in ("auto", "sqrt", "all", "log2", "onethird", "5", "40", "0.3")]
    assert sizes == [4, 4, 12, 4, 4, 5, 12, 4] and forests.subset_size("auto", 1, 12) == 12


def test_counted_forest_takes_whole_rows_only(spark):
    estimator = models.RandomForestClassifier(labelCol="y", weightCol="w", numTrees=2)
    good = [(Vectors.dense(float(i), 1.0), float(i % 2), 1.0) for i in range(40)]
    for bad in ((Vectors.dense(math.nan, 1.0), 0.0, 1.0), (None, 0.0, 1.0), (good[0][0], None, 1.0), (good[0][0], 0.0, 2.0)):
        with pytest.raises(Exception, match="must be"):
            forests.fit_forest(estimator, spark.createDataFrame([*good, bad], ["features", "y", "w"]), [2])


def test_settings_of_the_full_study():
    forest = models.classifier("rf", "y")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (200, 8, 42)
    boosted = models.classifier("gbt", "y", weight=None)
    assert (boosted.getMaxIter(), boosted.getStepSize()) == (50, 0.1)


def test_sensitivity_has_a_row_per_forest(parts):
    rows = models.forest_sensitivity(parts.train, parts.test, LABEL, trees=(2, 5)).collect()
    assert [r["n_trees"] for r in rows] == [2, 5] and all(r["auc"] > 0.7 for r in rows)


def cloud(spark):
    rng = random.Random(3)
    rows = [(Vectors.dense(rng.gauss(4 * (i % 3), 1), rng.gauss(0, 1)), i % 3) for i in range(200)]
    return spark.createDataFrame(rows, ["v", "c"])


def pairwise(points):
    total = 0.0
    for x, c in points:
        by = {}
        for y, d in points:
            by.setdefault(d, []).append(sum((a - b) ** 2 for a, b in zip(x, y)))
        own = by.pop(c)
        if len(own) > 1:
            a, b = sum(own) / (len(own) - 1), min(sum(v) / len(v) for v in by.values())
            total += (b - a) / max(a, b) if max(a, b) else 0.0
    return total / len(points)


def test_silhouette(spark):
    df = cloud(spark)
    ours = clusters.silhouette(df, "v", "c").first()["silhouette"]
    assert ours == pytest.approx(pairwise([(r["v"].toArray(), r["c"]) for r in df.collect()]), abs=1e-9)
    ml = ClusteringEvaluator(featuresCol="v", predictionCol="c").evaluate(df.withColumn("c", F.col("c").cast("double")))
    assert ours == pytest.approx(ml, abs=1e-9)


def test_silhouette_of_singletons_and_one_cluster(spark):
    alone = spark.createDataFrame([(Vectors.dense(float(i)), i) for i in range(3)], ["v", "c"])
    assert clusters.silhouette(alone, "v", "c").first()["silhouette"] == 0.0
    with pytest.raises(ValueError, match="two clusters"):
        clusters.silhouette(alone.withColumn("c", F.lit(1)), "v", "c")


def test_cluster_screening_and_profile(spark):
    df = cloud(spark).withColumnRenamed("v", "features").withColumn("x", F.col("c").cast("double")).withColumn("y", F.col("c") % 2)
    screened = {r["k"]: r["silhouette"] for r in clusters.screen_k(df, (2, 3)).collect()}
    assert screened[3] > 0.5 and all(math.isfinite(s) for s in screened.values())
    assigned = clusters.fit_clusters(df, 3)
    profile = clusters.cluster_profile(assigned, "cluster", ["x"], "y").collect()
    assert sum(r["n_rows"] for r in profile) == 200 and len(profile) == 3
    assert all(0 <= r["prevalence"] <= 1 for r in profile)


def test_screening_agrees_with_the_evaluator(spark):
    df = cloud(spark).withColumnRenamed("v", "features").select("features")
    screened = clusters.screen(df, (2, 4))
    for row in screened.table.collect():
        assigned = screened.models[row["k"]].transform(df)
        evaluated = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(assigned)
        assert row["silhouette"] == pytest.approx(evaluated, abs=1e-9)


def test_silhouette_by_blocks(spark):
    """Blocks of one cluster, copies, a singleton, and rows that take no part."""
    df = cloud(spark).select("v", F.col("c").cast("int").alias("c"))
    extra = spark.createDataFrame([(Vectors.dense(9.0, 9.0), 99), (Vectors.dense(0.0, 0.0), None), (None, 1)], df.schema)
    df = df.unionByName(df.limit(7)).unionByName(extra).persist()
    one = clusters.silhouette(df, "v", "c").first()
    many = clusters.silhouette(df, "v", "c", block_numbers=2).first()
    assert one["n_rows"] == many["n_rows"] == df.count() - 2
    assert one["silhouette"] == pytest.approx(many["silhouette"], abs=1e-9)
