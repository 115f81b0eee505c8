"""Classification metrics against plain Python and Spark ML."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cohortry.operators import metrics

SCHEMA = "id long, score double, y int, pred int, grp int"
BUCKETS = {"strategy": "buckets", "rows_per_task": 50}


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.35)
        score = round(min(0.99, max(0.0, rng.gauss(0.3 + 0.3 * y, 0.2))), 2) if i % 3 else 0.4
        rows.append((i, score, y, int(score >= 0.4), rng.choice([None, 1, 2, 3])))
    return spark.createDataFrame(rows, SCHEMA).cache()


def local_auc(rows):
    pos = [r["score"] for r in rows if r["y"] == 1]
    neg = [r["score"] for r in rows if r["y"] == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("options", [{}, BUCKETS], ids=["auto", "buckets"])
def test_auc(scored, options):
    got = metrics.auc(scored, "y", "score", **options).first()["auc"]
    assert got == pytest.approx(local_auc(scored.collect()), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0)
    assert got == pytest.approx(evaluator.evaluate(scored), abs=1e-9)
    mirrored = scored.withColumn("score", -F.col("score"))
    assert metrics.auc(mirrored, "y", "score", **options).first()["auc"] == pytest.approx(1 - got)


def test_auc_of_one_class_is_null(scored):
    assert metrics.auc(scored.where("y = 1"), "y", "score").first()["auc"] is None


def test_confusion(scored):
    rows = scored.collect()
    count = lambda y, p: sum(r["y"] == y and r["pred"] == p for r in rows)
    m = metrics.confusion_metrics(scored, "y", "pred").first()
    assert (m["tp"], m["tn"], m["fp"], m["fn"]) == (count(1, 1), count(0, 0), count(0, 1), count(1, 0))
    assert m["accuracy"] == pytest.approx((m["tp"] + m["tn"]) / 600)
    assert m["f1"] == pytest.approx(2 * m["tp"] / (2 * m["tp"] + m["fp"] + m["fn"]))
    assert m["reconciles"]
    table = {(r["y"], r["pred"]): r["n_rows"] for r in metrics.confusion_table(scored, "y", "pred").collect()}
    assert table[(1, 1)] == m["tp"] and sum(table.values()) == 600


def test_null_predictions_break_reconciliation(scored):
    holes = scored.withColumn("pred", F.when(F.col("id") > 9, F.col("pred")))
    m = metrics.confusion_metrics(holes, "y", "pred")
    assert not m.first()["reconciles"]
    with pytest.raises(ValueError, match="590, not 600"):
        metrics.check_confusion(m, "holes")
    metrics.check_confusion(metrics.confusion_metrics(scored, "y", "pred"))


def test_empty_denominators_give_zero(spark):
    df = spark.createDataFrame([(1, 0.1, 0, 0, 1)], SCHEMA)
    m = metrics.confusion_metrics(df, "y", "pred").first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert metrics.baseline_metrics(df, "y", "pred").first()["flagged_per_case"] is None


def test_record_gathers_the_parts(scored):
    record = metrics.evaluate(scored, "m", "y", "score", "pred", "id").first()
    assert record["model"] == "m"
    assert record["auc"] == metrics.auc(scored, "y", "score").first()["auc"]
    assert record["recall"] == metrics.confusion_metrics(scored, "y", "pred").first()["recall"]
    assert record["top_contacts"] == 120 and record["top_lift"] == pytest.approx(record["top_capture"] / 0.2)
    assert 0 < record["depth_to_target"] < 1
    again = metrics.evaluate(scored.repartition(9), "m", "y", "score", "pred", "id", **BUCKETS).first()
    assert again.asDict() == pytest.approx(record.asDict())


def test_comparison_is_ordered_by_auc(scored):
    df = scored.withColumn("worse", -F.col("score"))
    names = [r["model"] for r in metrics.compare_models(df, {"a": ("worse", "pred"), "b": ("score", "pred")}, "y", "id").collect()]
    assert names == ["b", "a"]


def test_subgroups_add_up(scored):
    rules = {"base": "pred", "high": "high"}
    df = scored.withColumn("high", (F.col("score") > 0.5).cast("int"))
    rows = metrics.subgroup_recall(df, "grp", "y", rules, "base", overall=True).collect()
    groups = [r for r in rows if not r["is_overall"]]
    total = next(r for r in rows if r["is_overall"])
    assert None in {r["grp"] for r in groups} and len(groups) == 4
    for column in ("actual_positive", "base_tp", "high_tp"):
        assert sum(r[column] for r in groups) == total[column]
    m = metrics.confusion_metrics(df, "y", "pred").first()
    assert total["base_recall"] == pytest.approx(m["recall"])
    assert total["high_vs_base"] == pytest.approx(total["high_recall"] - total["base_recall"])
    plain = metrics.subgroup_recall(df, "grp", "y", rules, "base")
    assert plain.count() == 4


def test_group_without_positives_has_no_recall(spark):
    df = spark.createDataFrame([(1, 0.1, 0, 1, 7)], SCHEMA)
    row = metrics.subgroup_recall(df, "grp", "y", {"base": "pred"}, "base").first()
    assert (row["actual_positive"], row["base_recall"]) == (0, None)


def test_baseline_at_a_capacity(scored):
    row = metrics.baseline_metrics(scored, "y", "pred", "score", "id").first()
    assert row["flagged"] == row["tp"] + row["fp"]
    assert row["flagged_per_case"] == pytest.approx(row["flagged"] / row["tp"])
    assert row["contacts"] == 120
