"""Exact quantiles of many columns at once, without sorting any column in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.expressions import count_where

# Distinct values of one column that one task may order.
VALUES_PER_TASK = 2_000_000
# Half-width, in rank, of the bracket one narrowing round puts around the quantile.
BRACKET = 0.01


def exact_quantiles(
    df: DataFrame, columns: list[str], q: float = 0.5, values_per_task: int = VALUES_PER_TASK
) -> dict[str, float | None]:
    """The value at rank ``ceil(q n)`` of each column's known values; None for a column of nulls.

    Values are counted before they are ordered, so repeated values cost nothing. A column
    with more distinct values than one task should order is narrowed first: approximate
    quantiles bracket the wanted rank, the rows below the bracket are counted, and only
    values inside it remain. Each round keeps a few percent and takes two jobs, however many columns are wide;
    the driver holds two numbers per column and wide column.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    if numbers.count() <= values_per_task:
        found = {row["column_name"]: row["value"] for row in _value_at_rank(numbers, columns, q).collect()}
        return {c: found.get(c) for c in columns}
    sizes = numbers.agg(
        *[F.count(c).alias(f"{c}__n") for c in columns],
        *[F.approx_count_distinct(c).alias(f"{c}__d") for c in columns],
    ).first()
    result: dict[str, float | None] = {}
    ranks: dict[str, int] = {}
    brackets: dict[str, tuple[float, float]] = {}
    wide: dict[str, int] = {}
    for c in columns:
        rows = sizes[f"{c}__n"]
        if rows == 0:
            result[c] = None
            continue
        ranks[c] = max(1, math.ceil(q * rows))
        brackets[c] = (float("-inf"), float("inf"))
        if sizes[f"{c}__d"] > values_per_task:
            wide[c] = rows

    while wide:
        aggregates = []
        # All columns take one quantile job: values outside a column's bracket are masked, and each picks its own two answers.
        masked = numbers.select(*[F.when(F.col(c).between(*brackets[c]), F.col(c)).alias(c) for c in wide])
        at = [(ranks[c] - 0.5) / rows for c, rows in wide.items()]
        probs = [p for a in at for p in (max(0.0, a - BRACKET), min(1.0, a + BRACKET))]
        answers = masked.approxQuantile(list(wide), probs, BRACKET / 2)
        for i, c in enumerate(wide):
            low, high = brackets[c]
            new_low, new_high = brackets[c] = tuple(answers[i][2 * i : 2 * i + 2])
            within = F.col(c).between(new_low, new_high)
            aggregates += [
                count_where((F.col(c) >= low) & (F.col(c) < new_low)).alias(f"{c}__below"),
                count_where(within).alias(f"{c}__n"),
                F.approx_count_distinct(F.when(within, F.col(c))).alias(f"{c}__d"),
            ]
        counts = numbers.agg(*aggregates).first()
        for c in list(wide):
            ranks[c] -= counts[f"{c}__below"]
            wide[c] = counts[f"{c}__n"]
            if brackets[c][0] == brackets[c][1]:
                result[c] = brackets.pop(c)[0]
                del wide[c]
            elif counts[f"{c}__d"] <= values_per_task:
                del wide[c]

    if brackets:
        inside = [F.when(F.col(c).between(low, high), F.col(c)).alias(c) for c, (low, high) in brackets.items()]
        found = _value_at_rank(numbers.select(*inside), list(brackets), q, ranks)
        result.update({row["column_name"]: row["value"] for row in found.collect()})
    return result


def _value_at_rank(
    numbers: DataFrame, columns: list[str], q: float, ranks: dict[str, int] | None = None
) -> DataFrame:
    """Per column the value at rank ``ceil(q n)``, or at the given rank among the values left."""
    values = (
        numbers.unpivot([], columns, "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    column = Window.partitionBy("column_name")
    wanted = F.greatest(F.ceil(F.sum("n").over(column) * q), F.lit(1))
    for c, rank in (ranks or {}).items():
        wanted = F.when(F.col("column_name") == c, rank).otherwise(wanted)
    counted = values.select("*", F.sum("n").over(column.orderBy("value")).alias("upto"), wanted.alias("wanted"))
    return counted.where(
        (F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))
    ).select("column_name", "value")
