"""Cleaning steps: identifier, unknown targets, duplicate profiles, missingness, caps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.expressions import capped, count_nulls, count_where


def drop_identifier(df: DataFrame, column: str) -> DataFrame:
    return df.drop(column)


def require_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def target_report(df: DataFrame, target: str) -> DataFrame:
    """One row: rows before, removed for an unknown target, remaining."""
    return df.agg(
        F.count("*").alias("rows_before"),
        count_where(F.col(target).isNull()).alias("rows_removed"),
        F.count(target).alias("rows_remaining"),
    )


#: Rows of a profile, in a table of profiles.
COPIES = "__copies"


def count_profiles(df: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct profiles over every column but the key, with their rows in ``COPIES`` and the smallest key.

    It runs as an aggregation with map-side combine, so a profile that makes up a third
    of the rows reaches the shuffle as one row per task. Duplicates and the audit of stages both follow from it.
    """
    profile = [c for c in df.columns if c != key]
    kept = [F.min(key).alias(key)] if key else []
    counted = df.groupBy(*profile).agg(F.count("*").alias(COPIES), *kept)
    return counted.select(*([key] if key else []), *profile, COPIES)


def dedup_profiles(df: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct profiles over every column but the key; the smallest key of each is kept.

    Keeping a key lets the split be a function of the row, and copies can never straddle the two parts.
    """
    if key is None:
        return df.dropDuplicates(df.columns)
    return count_profiles(df, key).drop(COPIES)


def missing_indicators(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<c>_missing`` as 0/1 for each listed column the table has."""
    present = [c for c in columns if c in df.columns]
    return df.select("*", *[F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in present])


def missing_count(df: DataFrame, columns: list[str], out: str = "n_missing_fields") -> DataFrame:
    """Number of unknown predictors per row; name the base predictors, not the indicators."""
    return df.withColumn(out, count_nulls(columns))


def cap(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.withColumn(column, capped(column, limit))


def cap_report(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.agg(
        F.count(column).alias("rows_known"),
        count_where(F.col(column) > limit).alias("rows_capped"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null is a group of its own."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))
