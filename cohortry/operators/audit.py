"""Audits: expected columns, table profile, rows per stage, row traceability."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.expressions import count_where
from cohortry.operators.cleaning import COPIES, count_profiles


def require_columns(df: DataFrame, columns: list[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"expected columns are absent: {absent}")


def schema_table(df: DataFrame) -> DataFrame:
    """``position, column, type`` of a table, for reports."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def _rows_from_one(totals: DataFrame, entries: list[dict]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry (name -> Column over the aggregate)."""
    structs = [F.struct(*[c.alias(n) for n, c in entry.items()]) for entry in entries]
    return totals.select(F.inline(F.array(*structs)))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of each numeric column.

    One aggregation for all columns; one output row per column. Text that is no number
    counts as known but has no mean or range.
    """
    aggregates = []
    for c in columns:
        number = F.col(c).try_cast("double")
        aggregates += [
            F.count(c).alias(f"{c}__count"),
            F.avg(number).alias(f"{c}__mean"),
            F.stddev_samp(number).alias(f"{c}__stddev"),
            F.min(number).alias(f"{c}__min"),
            F.max(number).alias(f"{c}__max"),
        ]
    totals = df.agg(F.count("*").alias("n_rows"), *aggregates)
    return _rows_from_one(
        totals,
        [
            {
                "column_name": F.lit(c),
                "n_rows": F.col("n_rows"),
                "n_known": F.col(f"{c}__count"),
                "mean": F.col(f"{c}__mean"),
                "stddev": F.col(f"{c}__stddev"),
                "min": F.col(f"{c}__min"),
                "max": F.col(f"{c}__max"),
            }
            for c in columns
        ],
    )


def stage_audit(
    df: DataFrame, key: str, target: str, cap_column: str, cap_limit: float, indicators: list[str]
) -> DataFrame:
    """Rows before, after and touched for each cleaning step, from one pass over the table."""
    return audit_profiles(count_profiles(df, key if key in df.columns else None), target, cap_column, cap_limit, indicators)


def audit_profiles(profiles: DataFrame, target: str, cap_column: str, cap_limit: float, indicators: list[str]) -> DataFrame:
    """The same from a table of profiles with their number of rows: every figure is a conditional sum over profiles."""
    known = F.col(target).isNotNull()
    totals = profiles.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("source"),
        F.coalesce(F.sum(F.when(known, F.col(COPIES))), F.lit(0)).alias("known"),
        count_where(known).alias("distinct"),
        count_where(known & (F.col(cap_column) > cap_limit)).alias("capped"),
    )
    marked = sorted(f"{c}_missing" for c in indicators if c in profiles.columns)
    steps = [
        ("1 target", "source", "known", F.col("source") - F.col("known"), ""),
        ("2 duplicates", "known", "distinct", F.col("known") - F.col("distinct"), ""),
        ("3 indicators", "distinct", "distinct", F.lit(0).cast("bigint"), ",".join(marked)),
        ("4 cap", "distinct", "distinct", F.col("capped"), ""),
    ]
    return _rows_from_one(
        totals,
        [
            {
                "step": F.lit(step),
                "rows_before": F.col(before),
                "rows_after": F.col(after),
                "rows_affected": affected,
                "detail": F.lit(detail),
            }
            for step, before, after, affected, detail in steps
        ],
    )


def trace_rows(tables: dict[str, DataFrame], expected: int) -> DataFrame:
    """Row count of each table against the expected number: OK or CHECK."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).select(
        "table_name",
        "n_rows",
        F.lit(expected).cast("bigint").alias("expected_rows"),
        F.when(F.col("n_rows") == expected, "OK").otherwise("CHECK").alias("status"),
    )


def best_by(df: DataFrame, metric: str, tiebreak: str) -> DataFrame:
    """The row with the largest metric; the smaller tie-break value wins ties."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(tiebreak).asc_nulls_last()).limit(1)
