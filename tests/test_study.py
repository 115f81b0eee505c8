"""The whole study, on the stand-in table and on a CSV with the survey's column names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortry.operators import splitting
from cohortry.plans import registry, study
from cohortry.sources import reference
from cohortry.sources.respondents import respondents
from cohortry.sources.tables import read_csv, write_csv

SF = "/root/testdata/sf0.001"
SMALL = {"dt": {"minInstancesPerNode": 20}, "rf": {"numTrees": 5, "maxDepth": 4}, "gbt": {"maxIter": 3}}


def report(spark, path):
    return read_csv(spark, path)


def test_stand_in(spark, tmp_path):
    paths = study.run_study(
        spark, respondents(spark, SF), study.STAND_IN, str(tmp_path), overrides=SMALL, ks=(2, 3), top=12, trees=(2, 5)
    )
    comparison = report(spark, paths["model_comparison"]).collect()
    assert {r["model"] for r in comparison} == {"lr", "dt", "rf", "gbt"}
    assert [r["auc"] for r in comparison] == sorted((r["auc"] for r in comparison), reverse=True)
    assert all(r["auc"] > 0.75 for r in comparison)
    assert {r["status"] for r in report(spark, paths["trace_rows"]).collect()} == {"OK"}
    assert report(spark, paths["selected_features"]).count() == 12
    assert report(spark, paths["cluster_screening"]).count() == 2
    assert report(spark, paths["gains_lr"]).count() == 8
    assert report(spark, paths["thresholds_gbt"]).count() == 4
    assert [r["n_trees"] for r in report(spark, paths["forest_sensitivity"]).collect()] == [2, 5]
    assert report(spark, paths["confusion_lr"]).agg(F.sum("n_rows")).first()[0] == spark.read.parquet(paths["test"]).count()
    assert {"observed_codes", "class_weights", "baseline_expected_ties"} <= set(paths)
    prepared = spark.read.parquet(paths["prepared"])
    assert prepared.count() == registry.prepared(spark, SF).count()
    scored = spark.read.parquet(paths["scored"])
    overall = report(spark, paths["subgroup_recall"]).where("is_overall = 1").first()
    assert overall["actual_positive"] == scored.agg(F.sum("target")).first()[0]


NAMES = {
    "id": "ID", "age": "Age", "bmi": "BMI", "sex": "Sex", "high_bp": "HighBP", "phys_activity": "PhysActivity",
    "gen_hlth": "GenHlth", "income": "Income", "ment_hlth": "MentHlth", "stroke": "Stroke",
    "heart_disease": "HeartDiseaseorAttack", "diff_walk": "DiffWalk", "target": "Diabetes_binary",
}


def survey(spark):
    df = respondents(spark, SF).withColumnsRenamed(NAMES)
    return df.withColumns({
        "PhysHlth": (F.col("MentHlth") + 3) % 31,
        "Education": 1 + F.col("ID") % 6,
        "HighChol": F.when(F.col("ID") % 11 != 0, F.col("ID") % 2),
        "HvyAlcoholConsump": F.when(F.col("ID") % 13 != 0, (F.col("ID") % 17 == 0).cast("int")),
        "CholCheck": F.when(F.col("ID") % 5 != 0, F.lit(1)),
    })


@pytest.mark.parametrize("with_id", [True, False])
def test_survey_csv(spark, tmp_path, with_id):
    df = survey(spark)
    write_csv(df if with_id else df.drop("ID"), str(tmp_path / "survey"))
    reference._values_table(spark, reference.CODE_LABELS, reference.LABEL_SCHEMA).write.option("header", True).csv(str(tmp_path / "labels"))
    reference._values_table(spark, reference.BMI_BANDS, reference.BAND_SCHEMA).write.option("header", True).csv(str(tmp_path / "bands"))
    paths = study.run_survey(
        spark, str(tmp_path / "survey"), str(tmp_path / "out"), str(tmp_path / "labels"), str(tmp_path / "bands"),
        schema=df.schema if with_id else None, overrides=SMALL, ks=(2,), trees=(2,),
    )
    assert spark.read.parquet(paths["source"]).count() == df.count()
    prepared = spark.read.parquet(paths["prepared"])
    built = {"BMI_band", "MentHlth_band", "PhysHlth_band", "RiskTest5", "RiskTest5_flag", "ComorbidityCount", "n_missing_fields"}
    assert built | {f"{c}_missing" for c in study.SURVEY.indicators} <= set(prepared.columns)
    assert prepared.select("ID").distinct().count() == prepared.count()
    assert report(spark, paths["selected_features"]).count() == study.TOP_FEATURES
    assert report(spark, paths["model_comparison"]).count() == 4


def test_bad_code_stops_the_study(spark, tmp_path):
    df = respondents(spark, SF).withColumn("age", F.when(F.col("id") == 5, 99).otherwise(F.col("age")))
    with pytest.raises(ValueError, match="age=99.0"):
        study.run_study(spark, df, study.STAND_IN, str(tmp_path), overrides=SMALL)


def test_copies_never_straddle_the_split(spark):
    """The copies carry other ids; after preparation each profile is in one part only."""
    prepared = registry.prepared(spark, SF)
    profile = [c for c in prepared.columns if c not in ("id", splitting.SPLIT_COLUMN)]
    parts = prepared.groupBy(*profile).agg(F.countDistinct(splitting.SPLIT_COLUMN).alias("n"), F.count("*").alias("rows"))
    assert parts.where("n > 1 or rows > 1").count() == 0


def test_split_ignores_partitioning(spark):
    df = registry.known(spark, SF).select("id")
    first = {tuple(r) for r in splitting.stable_split(df.repartition(2), "id").collect()}
    second = {tuple(r) for r in splitting.stable_split(df.repartition(7), "id").collect()}
    assert first == second


def test_recomputing_agrees_with_imputed_answers(spark):
    df = study.recompute_constructed(registry.imputed(spark, SF), study.STAND_IN, reference.bmi_bands(spark))
    assert df.where("risk_points is null or (risk_flag = 1) <> (risk_points >= 5)").count() == 0
    assert df.where("bmi >= 30 and bmi_band <> 4").count() == 0


def test_rewritten_source_is_read_again(spark, tmp_path):
    for name in ("orders", "customer"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    first = registry.stored_prepared(spark, str(tmp_path))
    n = first.count()
    again = registry.stored_prepared(spark, str(tmp_path))
    assert n > 0 and first.inputFiles() == again.inputFiles()
    some = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(F.col("o_orderkey") % 2 == 0)
    some.write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert 0 < registry.stored_prepared(spark, str(tmp_path)).count() < n
