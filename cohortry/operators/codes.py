"""Validation of coded columns against a table of code labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators.audit import require_columns


def observed_codes(df: DataFrame, variables: list[str]) -> DataFrame:
    """``variable, code, n_rows`` for every non-null code.

    The columns are unpivoted in one scan and counted with map-side combine, so each task
    sends one row per distinct code however many respondents share it.
    """
    require_columns(df, variables)
    return (
        df.select(*[F.col(v).cast("double").alias(v) for v in variables])
        .unpivot([], variables, "variable", "code")
        .where(F.col("code").isNotNull())
        .groupBy("variable", "code")
        .agg(F.count("*").alias("n_rows"))
    )


def validate_codes(
    df: DataFrame,
    labels: DataFrame,
    variables: list[str],
    names: dict[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Observed codes without a label. ``names`` maps our column names to the label table's.

    The join sees distinct codes only, on both sides, so it needs no broadcast hint: Spark
    broadcasts by size if it pays. ``strict`` raises on the first violations.
    """
    names = names or {}
    known = labels.where(F.col("label").isNotNull()).select(
        F.col("variable").alias("ref_variable"), F.col("code").cast("double").alias("ref_code")
    )
    observed = observed_codes(df, variables)
    ref_name = F.col("variable")
    for ours, theirs in names.items():
        ref_name = F.when(F.col("variable") == ours, theirs).otherwise(ref_name)
    violations = observed.join(
        known, (ref_name == F.col("ref_variable")) & (F.col("code") == F.col("ref_code")), "left_anti"
    )
    if strict:
        found = violations.limit(20).collect()
        if found:
            listed = ", ".join(f"{r['variable']}={r['code']}" for r in found)
            raise ValueError(f"codes without a label: {listed}")
    return violations
