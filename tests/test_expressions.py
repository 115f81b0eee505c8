"""Row expressions on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortry.functions.expressions import (
    at_least, capped, count_band, count_nulls, key_slot, points_total, positive_score, safe_ratio,
)
from cohortry.operators.points import risk_rules


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_safe_ratio_never_divides_by_zero(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0)], "a long, b long")
    assert values(df, safe_ratio(F.col("a"), F.col("b"))) == [0.5, None, None]
    assert values(df, safe_ratio(F.col("a"), F.col("b"), 0.0)) == [0.5, 0.0, 0.0]


def test_cap_keeps_null_and_treats_nan_as_above(spark):
    df = spark.createDataFrame([(59.9,), (60.0,), (60.1,), (None,), (float("nan"),)], "x double")
    assert values(df, capped("x", 60)) == [59.9, 60.0, 60.0, None, 60.0]


def test_count_band(spark):
    df = spark.createDataFrame([(0,), (1,), (14,), (15,), (None,)], "x int")
    assert values(df, count_band("x", (14,))) == [0, 1, 1, 2, None]


def test_flag_keeps_null(spark):
    df = spark.createDataFrame([(4,), (5,), (None,)], "x int")
    assert values(df, at_least("x", 5)) == [0, 1, None]


@pytest.mark.parametrize(
    "row, points",
    [
        ((4, 24.9, 0, 0, 1), 0),
        ((5, 25.0, 0, 0, 1), 2),
        ((7, 30.0, 0, 0, 1), 4),
        ((9, 40.0, 1, 1, 0), 9),
        ((13, 39.9, 1, 0, 0), 7),
        ((None, 20.0, 0, 0, 1), None),
        ((9, 40.0, 1, None, 0), None),
    ],
)
def test_risk_points(spark, row, points):
    df = spark.createDataFrame([row], "age int, bmi double, sex int, bp int, act int")
    assert values(df, points_total(risk_rules("age", "bmi", "sex", "bp", "act"))) == [points]


def test_null_count_of_no_columns_is_zero(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert values(df, count_nulls([])) == [0]
    assert values(df, count_nulls(["a", "b"])) == [1]


def test_key_slot_ignores_partitioning_and_order(spark):
    ids = spark.range(5_000)
    slots = {r["id"]: r["s"] for r in ids.select("id", key_slot("id").alias("s")).collect()}
    again = ids.repartition(13).orderBy(F.desc("id")).select("id", key_slot("id").alias("s")).collect()
    assert {r["id"]: r["s"] for r in again} == slots
    assert all(0 <= s < 10_000 for s in slots.values())
    assert 0.67 < sum(s < 7_000 for s in slots.values()) / 5_000 < 0.73
    seeded = {r["id"]: r["s"] for r in ids.select("id", key_slot("id", seed=1).alias("s")).collect()}
    assert seeded != slots


def test_positive_score(spark):
    df = spark.createDataFrame([(Vectors.dense(0.25, 0.75),)], ["probability"])
    assert values(df, positive_score()) == [0.75]
    empty = df.select(F.when(F.lit(False), F.col("probability")).alias("probability"))
    assert values(empty, positive_score(empty=0.0)) == [0.0]
