"""Constructed features: count bands, point scores, flags and condition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortry.functions.expressions import (
    MatchPoints,
    StepPoints,
    at_least,
    count_band,
    points_total,
)

# Cuts of the health-day bands and of the published risk test.
HEALTH_DAY_CUTS = (14,)
AGE_STEPS = ((5, 0), (7, 1), (9, 2))
AGE_ABOVE = 3
BMI_STEPS = ((25, 0), (30, 1), (40, 2))
BMI_ABOVE = 3
RISK_THRESHOLD = 5


def risk_rules(age: str, bmi: str, sex: str, high_bp: str, activity: str) -> list[StepPoints | MatchPoints]:
    """The five components of the risk test, 0 to 9 points in all."""
    return [
        StepPoints(age, AGE_STEPS, AGE_ABOVE),
        StepPoints(bmi, BMI_STEPS, BMI_ABOVE),
        MatchPoints(sex, 1),
        MatchPoints(high_bp, 1),
        MatchPoints(activity, 0),
    ]


def band(df: DataFrame, column: str, out: str, cuts: tuple[int, ...] = HEALTH_DAY_CUTS) -> DataFrame:
    return df.withColumn(out, count_band(column, cuts))


def point_score(df: DataFrame, rules: list[StepPoints | MatchPoints], out: str) -> DataFrame:
    return df.withColumn(out, points_total(rules))


def threshold_flag(df: DataFrame, column: str, out: str, threshold: float = RISK_THRESHOLD) -> DataFrame:
    return df.withColumn(out, at_least(column, threshold))


def condition_count(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """How many of the 0/1 conditions are present, null when any is unknown."""
    return df.withColumn(out, points_total([MatchPoints(c, 1) for c in columns]))
