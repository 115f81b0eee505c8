"""Models as tables: scores from them against Spark ML and against DuckDB over the stored tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortry.operators import clusters, model_tables, models
from cohortry.plans import registry
from cohortry.sources.tables import write_table

SF = "/root/testdata/sf0.001"
SMALL = {"rf": {"numTrees": 7, "maxDepth": 5, "minInstancesPerNode": 5}, "gbt": {"maxIter": 5}, "dt": {"minInstancesPerNode": 20}}


@pytest.fixture(scope="module")
def parts(spark):
    parts = registry._transformed(spark, SF)
    parts.train.cache(), parts.test.cache()
    return parts


@pytest.fixture(scope="module")
def fitted(parts):
    return models.fit_classifiers(parts.train, "target", overrides=SMALL)


def stored_scores(tmp_path, tables, sql):
    con = duckdb.connect()
    for name, df in tables.items():
        write_table(df, str(tmp_path / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path / name}/*.parquet'")
    return dict(con.execute(sql).fetchall())


WALK = """
WITH RECURSIVE walk AS (
    SELECT id, x, tree, 0 AS node FROM points, (SELECT DISTINCT tree FROM nodes)
    UNION ALL
    SELECT w.id, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END
    FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n."left" >= 0),
sums AS (
    SELECT w.id, sum(n.value * n.weight) AS s, any_value(n.link) AS link
    FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n."left" < 0 GROUP BY w.id)
SELECT id, CASE WHEN link = 'logistic2' THEN 1 / (1 + exp(-2 * s)) ELSE s END FROM sums
"""


@pytest.mark.parametrize("name", ["dt", "rf", "gbt"])
def test_tree_scores(spark, parts, fitted, tmp_path, name):
    nodes = model_tables.node_table(spark, fitted[name])
    points = parts.test.select("id", vector_to_array("features").alias("x"))
    theirs = {r["id"]: r[f"{name}_score"] for r in models.score_models(parts.test, {name: fitted[name]}).collect()}
    ours = {r["id"]: r["s"] for r in model_tables.score_nodes(points, nodes, "x", "s").collect()}
    sql = stored_scores(tmp_path, {"points": points, "nodes": nodes}, WALK)
    assert ours == pytest.approx(theirs, abs=1e-12) and sql == pytest.approx(theirs, abs=1e-12)
    assert len(set(theirs.values())) > 5


def test_linear_scores(spark, parts, fitted, tmp_path):
    names = parts.selected
    x = vector_to_array("features")
    points = parts.test.select("id", *[x[i].alias(c) for i, c in enumerate(names)])
    table = model_tables.coefficient_table(spark, fitted["lr"], names)
    theirs = {r["id"]: r["lr_score"] for r in models.score_models(parts.test, {"lr": fitted["lr"]}).collect()}
    ours = {r["id"]: r["s"] for r in model_tables.score_linear(points, table, "s").collect()}
    sql = stored_scores(tmp_path, {"points": points, "coefficients": table}, f"""
        WITH long AS (UNPIVOT (SELECT id, {', '.join(f'{c}::DOUBLE AS {c}' for c in names)} FROM points) ON {', '.join(names)} INTO NAME feature VALUE x)
        SELECT id, 1 / (1 + exp(-(sum(x * coefficient) + (SELECT coefficient FROM coefficients WHERE feature = '(intercept)'))))
        FROM long JOIN coefficients USING (feature) GROUP BY id""")
    assert ours == pytest.approx(theirs, abs=1e-12) and sql == pytest.approx(theirs, abs=1e-12)


def test_clusters_and_profile(spark, parts, tmp_path):
    screened = clusters.screen(parts.train, (4,))
    centres = model_tables.centre_table(spark, screened.models[4])
    theirs = {r["id"]: r["cluster"] for r in screened.models[4].transform(parts.train).collect()}
    assigned = model_tables.assign_clusters(parts.train, centres, "features")
    assert {r["id"]: r["cluster"] for r in assigned.collect()} == theirs
    points = parts.train.select("id", vector_to_array("features").alias("x"))
    sql = stored_scores(tmp_path, {"points": points, "centres": centres}, """
        SELECT id, arg_min(cluster, list_sum([(a - b) * (a - b) for a, b in list_zip(x, centre)])) FROM points, centres GROUP BY id
        """.replace("[(a - b) * (a - b) for a, b in list_zip(x, centre)]", "list_transform(list_zip(x, centre), lambda p: (p[1] - p[2]) ** 2)"))
    assert sql == theirs


def test_odd_features_and_tables(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2.0, 1, 2, 0.5, 1.0, "identity"), (0, 1, -1, None, -1, -1, 0.25, 1.0, "identity"), (0, 2, -1, None, -1, -1, 0.75, 1.0, "identity")], model_tables.NODES
    )
    df = spark.createDataFrame([(1, 0.0, 2.0), (2, 0.0, 2.1), (3, None, None), (4, 0.0, float("nan"))], "tree int, a double, b double")
    got = model_tables.score_nodes(df, nodes, ["a", "b"], "s").orderBy("tree").collect()
    assert [r["s"] for r in got] == [0.25, 0.75, 0.75, 0.75] and got[0].asDict().keys() == {"tree", "a", "b", "s"}
    lone = nodes.where("node = 1").withColumn("node", F.lit(0))
    assert [r["s"] for r in model_tables.score_nodes(df, lone, ["a", "b"], "s").collect()] == [0.25] * 4
    with pytest.raises(ValueError, match="needs a tree"):
        model_tables.score_nodes(df, nodes.where("tree = 9"), ["a", "b"], "s")
    centres = spark.createDataFrame([(1, [0.0, 2.0]), (0, [0.0, 2.0]), (2, [9.0, 9.0])], "cluster int, centre array<double>")
    assert [r["cluster"] for r in model_tables.assign_clusters(df, centres, ["a", "b"]).orderBy("tree").collect()] == [0, 0, None, None]
    plan = model_tables.score_nodes(df, nodes, ["a", "b"], "s")._jdf.queryExecution().toString()
    assert "EvalPython" not in plan and "MapIn" not in plan and "NestedLoop" not in plan
