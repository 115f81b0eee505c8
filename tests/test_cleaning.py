"""Cleaning, audits, codes, bands and weights on hand-made rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cohortry.operators import audit, bands, cleaning, codes, splitting
from cohortry.sources import reference, scratch
from cohortry.sources.tables import read_csv, read_table, write_csv, write_report, write_table

PEOPLE = [(1, 1, 20.0, 1), (2, 1, 20.0, 1), (3, None, 70.0, 0), (4, None, 70.0, 0), (5, 2, None, None)]
SCHEMA = "id long, age int, bmi double, target int"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dedup_keeps_the_smallest_key_and_groups_nulls(people):
    assert rows(cleaning.dedup_profiles(people, "id")) == sorted([PEOPLE[0], PEOPLE[2], PEOPLE[4]], key=str)
    assert cleaning.dedup_profiles(people.drop("id")).count() == 3


def test_indicators_only_for_columns_present(people):
    out = cleaning.missing_indicators(people, ["age", "absent"])
    assert out.columns == [*people.columns, "age_missing"]
    assert [r["age_missing"] for r in out.orderBy("id").collect()] == [0, 0, 1, 1, 0]


def test_drop_identifier_is_silent_when_absent(people):
    assert cleaning.drop_identifier(people, "nope").columns == people.columns


def test_stage_audit_adds_up(people):
    steps = {r["step"]: r for r in audit.stage_audit(people, "id", "target", "bmi", 60, ["age", "x"]).collect()}
    assert steps["1 target"].asDict() | {"detail": ""} == {
        "step": "1 target", "rows_before": 5, "rows_after": 4, "rows_affected": 1, "detail": ""
    }
    assert (steps["2 duplicates"]["rows_before"], steps["2 duplicates"]["rows_after"]) == (4, 2)
    assert steps["3 indicators"]["detail"] == "age_missing"
    assert steps["4 cap"]["rows_affected"] == 1


def test_reports_agree_with_the_steps(people):
    assert tuple(cleaning.target_report(people, "target").first()) == (5, 1, 4)
    assert tuple(cleaning.cap_report(people, "bmi", 60).first()) == (4, 2)


def test_audits_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(cleaning.target_report(empty, "target").first()) == (0, 0, 0)
    assert audit.stage_audit(empty, "id", "target", "bmi", 60, []).where("rows_before <> 0").count() == 0
    assert audit.profile(empty, ["bmi"]).first()["n_known"] == 0


def test_profile_of_text_and_numbers(spark):
    df = spark.createDataFrame([("a", 1), ("2", 3), (None, None)], "t string, n int")
    rows_by = {r["column_name"]: r for r in audit.profile(df, ["t", "n"]).collect()}
    assert (rows_by["t"]["n_known"], rows_by["t"]["min"], rows_by["t"]["stddev"]) == (2, 2.0, None)
    assert (rows_by["n"]["n_rows"], rows_by["n"]["mean"]) == (3, 2.0)


def test_require_columns(people):
    audit.require_columns(people, ["age"])
    with pytest.raises(ValueError, match="nope"):
        audit.require_columns(people, ["age", "nope"])


def test_schema_table(people):
    assert rows(audit.schema_table(people))[0] == (1, "id", "bigint")


def test_trace_and_best(people):
    traced = {r["table_name"]: r["status"] for r in audit.trace_rows({"a": people, "b": people.limit(3)}, 5).collect()}
    assert traced == {"a": "OK", "b": "CHECK"}
    candidates = people.sparkSession.createDataFrame([(4, 0.2), (5, 0.3), (6, 0.3)], "k int, s double")
    assert audit.best_by(candidates, "s", "k").first()["k"] == 5


def test_codes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (9, None), (None, 1), (9, 0)], "gen int, sex int")
    labels = reference.code_labels(spark)
    names = {"gen": "GenHlth", "sex": "Sex"}
    assert rows(codes.observed_codes(df, ["gen", "sex"]))[-1] == ("sex", 1.0, 2)
    assert rows(codes.validate_codes(df, labels, ["gen", "sex"], names)) == [("gen", 9.0, 2)]
    with pytest.raises(ValueError, match="gen=9.0"):
        codes.validate_codes(df, labels, ["gen", "sex"], names, strict=True)
    unlabelled = labels.withColumn("label", F.when(F.col("variable") != "Sex", F.col("label")))
    assert codes.validate_codes(df, unlabelled, ["sex"], names).count() == 2


def test_reference_tables_are_whole(spark):
    assert reference.code_labels(spark).count() == 39
    assert [r["band_code"] for r in reference.bmi_bands(spark).orderBy("lower").collect()] == [1, 2, 3, 4]


VALUES = [(0.0,), (18.4,), (18.5,), (24.9,), (25.0,), (29.9,), (30.0,), (998.0,), (999.0,), (-1.0,), (None,), (float("nan"),)]
EXPECTED = [1, 1, 2, 2, 3, 3, 4, 4, None, None, None, None]


def test_band_forms_agree(spark, monkeypatch):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(VALUES)], "i int, x double")
    ref = reference.bmi_bands(spark)
    by_case = bands.band_by_reference(df, "x", ref, "band", expected=4)
    by_index = bands.band_by_reference(df, "x", ref, "band", max_case=2)
    by_cells = bands.band_by_reference(df, "x", ref, "band", max_case=2, max_indexed=2)
    for form in (by_case, by_index, by_cells):
        assert [r["band"] for r in form.orderBy("i").collect()] == EXPECTED
    with pytest.raises(ValueError, match="3 bands"):
        bands.band_by_reference(df, "x", ref, "band", expected=3)


def test_range_join_forms_agree_on_overlaps_and_gaps(spark):
    df = spark.range(0, 400).select("id", (F.col("id") / 7 - 5).alias("x"))
    df = df.union(spark.createDataFrame([(1000, None), (1001, float("nan"))], "id long, x double"))
    ref = spark.range(0, 60).select(
        F.col("id").cast("int").alias("band_code"),
        F.col("id").cast("double").alias("lower"),
        (F.col("id") + F.when(F.col("id") % 3 == 0, 5.5).when(F.col("id") % 3 == 1, 0.0).otherwise(0.4)).alias("upper"),
    )
    small = rows(bands.range_join(df, ref, "x").select("id", "band_code"))
    cells = rows(bands.range_join(df, ref, "x", max_indexed=5).select("id", "band_code"))
    assert small == cells
    assert len(small) > df.count()
    assert (1000, None) in small and (1001, None) in small


INF, NAN = float("inf"), float("nan")
LIMITS = [-INF, INF, NAN, 0.0, -0.0, 1.5, 1.5000001, -3.25, 1e300, -1e300, 2.0**60, 5e-324, 7.0, 8.0]


@pytest.mark.parametrize("seed", range(3))
def test_long_tables_of_any_bands(spark, seed):
    """Open, empty, reversed, unknown and repeated bands, null codes, and values on the limits, one of them hot."""
    rng = random.Random(seed)
    limit = lambda: rng.choice([*LIMITS, None, round(rng.uniform(-10, 10), 1)])
    table = [(rng.choice([None, rng.randint(0, 40)]), limit(), limit()) for _ in range(120)]
    values = [*LIMITS, None, *[round(rng.uniform(-11, 11), 1) for _ in range(60)], *[1.5] * 40]
    ref = spark.createDataFrame(table, "band_code int, lower double, upper double")
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    usable = [b for b in table if None not in b[1:] and b[1] == b[1] and b[2] == b[2] and b[1] < b[2]]
    inside = {i: [b for b in usable if v is not None and b[1] <= v < b[2]] for i, v in enumerate(values)}
    firsts = [(i, min((b[0] for b in found if b[0] is not None), default=None)) for i, found in inside.items()]
    joined = sorted((i, str(b[0])) for i, found in inside.items() for b in found or [(None,)])
    for case, indexed in ((500, 500), (64, 10_000), (5, 5)):
        got = bands.band_by_reference(df, "x", ref, "band", max_case=case, max_indexed=indexed)
        assert sorted((r["i"], r["band"]) for r in got.collect()) == firsts
        got = bands.range_join(df, ref, "x", max_indexed=indexed)
        assert sorted((r["i"], str(r["band_code"])) for r in got.collect()) == joined


def test_numbers_that_doubles_mix_up(spark):
    """Limits one apart above 2**53, and decimals that differ in the twentieth place."""
    big = 2**53
    df = spark.createDataFrame([(i, big + i) for i in range(-2, 6)], "i int, x bigint")
    ref = spark.createDataFrame([(k, big + k, big + k + 1) for k in range(4)], "band_code int, lower bigint, upper bigint")
    got = bands.band_by_reference(df, "x", ref, "band", max_case=1)
    assert sorted((r["i"], r["band"]) for r in got.collect()) == [(i, i if 0 <= i < 4 else None) for i in range(-2, 6)]
    fine = "cast(concat('1.', lpad(cast({} as string), 20, '0')) as decimal(38,20))".format
    df = spark.range(5).selectExpr("id", f"{fine('id')} as x")
    ref = spark.range(5).selectExpr("cast(id as int) band_code", f"{fine('id')} as lower", f"{fine('id + 1')} as upper")
    got = bands.band_by_reference(df, "x", ref, "band", max_case=1)
    assert all(r["id"] == r["band"] for r in got.collect())


def test_index_gives_up_on_heavy_overlaps():
    nested = [(float(-i), float(i), i) for i in range(1, 200)]
    assert bands.interval_index(nested, max_rows=1_000) is None
    segments, over = bands.interval_index(nested)
    assert len(segments) == 399 and max(map(len, over)) == 199
    assert bands.interval_index([]) == ([float("-inf")], [[]])


def test_no_nested_loops(spark):
    df = spark.range(1_000).selectExpr("id", "id / 7 as x")
    ref = spark.range(200).selectExpr("cast(id as int) as band_code", "id * 1.0D as lower", "id + 3.0D as upper")
    for indexed in (10_000, 5):
        for made in (bands.range_join(df, ref, "x", max_indexed=indexed), bands.band_by_reference(df, "x", ref, "band", max_case=1, max_indexed=indexed)):
            plan = made._jdf.queryExecution().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Exchange hash" not in bands.range_join(df, ref, "x")._jdf.queryExecution().executedPlan().toString()


def test_band_audit_finds_gap_overlap_and_stale_band(spark):
    df = spark.createDataFrame([(20.0, 2), (26.0, 3), (26.0, 1), (None, None)], "x double, band int")
    ref = reference.bmi_bands(spark)
    assert tuple(bands.audit_bands(df, ref, "x", "band").first()) == (3, 0, 1)
    gap = ref.where("band_code <> 2")
    assert tuple(bands.audit_bands(df, gap, "x", "band").first()) == (3, 1, 1)
    overlap = ref.withColumn("upper", F.when(F.col("band_code") == 2, 28.0).otherwise(F.col("upper")))
    assert tuple(bands.audit_bands(df, overlap, "x", "band").first()) == (5, 0, 3)
    with pytest.raises(ValueError, match="1 mismatched"):
        bands.require_clean_bands(bands.audit_bands(df, ref, "x", "band"))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert rows(splitting.class_weights(df, "y")) == [(0, 6, 8 / 12), (1, 2, 2.0)]
    assert rows(splitting.class_weights(df, "y", "ratio")) == [(0, 6, 1.0), (1, 2, 3.0)]
    alone = df.where("y = 0")
    assert rows(splitting.class_weights(alone, "y"))[0][2] == 7 / 12
    assert rows(splitting.class_weights(alone, "y", "ratio"))[1][2] == 1.0
    weighted = splitting.apply_weights(df, splitting.class_weights(df, "y"), "y")
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(8.0)


def test_files(spark, people, tmp_path):
    write_table(people, str(tmp_path / "t"), partition_by="target")
    assert rows(read_table(spark, str(tmp_path / "t")).select(*people.columns)) == rows(people)
    write_csv(people, str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c"), SCHEMA)) == rows(people)
    assert dict(read_csv(spark, str(tmp_path / "c")).dtypes)["bmi"] == "double"
    write_report(people.repartition(4), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch.scratch_path(spark, "x").startswith(root)
    df = spark.range(5)
    assert rows(scratch.stored(df, "five")) == rows(df)
