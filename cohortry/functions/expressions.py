"""Row-level expressions shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, empty: float | None = None) -> Column:
    """``numerator / denominator``, or ``empty`` where the denominator is not positive.

    Spark 4 raises on division by zero, so every ratio in the package goes through here.
    """
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(empty).cast("double"))


def is_positive(label: str) -> Column:
    """1 for a positive label, 0 for anything else, null included."""
    return F.when(F.col(label) == 1, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true, as bigint, 0 on empty input."""
    return F.count(F.when(condition, 1))


def any_null(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def count_nulls(columns: list[str]) -> Column:
    """How many of the columns are null in this row; 0 for an empty list."""
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns], F.lit(0))


def capped(column: str, limit: float) -> Column:
    """Values above ``limit`` become ``limit``; null stays null, NaN counts as above."""
    c = F.col(column)
    return F.when(c > limit, F.lit(float(limit))).otherwise(c.cast("double"))


def count_band(column: str, cuts: tuple[int, ...]) -> Column:
    """Band of a count: 0 for none, i for at most the i-th cut, one more beyond; null kept."""
    c = F.col(column)
    out = F.when(c.isNull(), F.lit(None).cast("int")).when(c == 0, 0)
    for band, cut in enumerate(cuts, start=1):
        out = out.when(c <= cut, band)
    return out.otherwise(len(cuts) + 1).cast("int")


@dataclass(frozen=True)
class StepPoints:
    """Points by value: the first step whose exclusive upper bound exceeds the value."""

    column: str
    steps: tuple[tuple[float, int], ...]
    above: int

    def points(self) -> Column:
        c = F.col(self.column)
        (bound, value), *rest = self.steps
        out = F.when(c < bound, value)
        for bound, value in rest:
            out = out.when(c < bound, value)
        return out.otherwise(self.above)


@dataclass(frozen=True)
class MatchPoints:
    """Points when the column equals a value, else none."""

    column: str
    value: int
    worth: int = 1

    def points(self) -> Column:
        return F.when(F.col(self.column) == self.value, self.worth).otherwise(0)


def points_total(rules: list[StepPoints | MatchPoints]) -> Column:
    """Sum of the rules' points, null when any component is unknown."""
    total = reduce(add, [r.points() for r in rules])
    return F.when(~any_null([r.column for r in rules]), total.cast("int"))


def at_least(column: str, threshold: float) -> Column:
    """1/0 flag for ``column >= threshold``; null stays null."""
    return (F.col(column) >= threshold).cast("int")


def key_slot(key: str, slots: int = 10_000, seed: int | None = None) -> Column:
    """A slot in ``0..slots-1`` from the md5 of the key.

    A pure function of the key: the same respondent gets the same slot whatever the
    partitioning, the order of rows or the number of retries.
    """
    text = F.col(key).cast("string")
    if seed is not None:
        text = F.concat(F.lit(f"{seed}:"), text)
    head = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % slots


def positive_score(probability: str = "probability", empty: float | None = None) -> Column:
    """Positive-class probability out of a vector column, natively in the JVM.

    A null vector gives ``empty``; the conversion alone would raise on it.
    """
    score = F.when(F.col(probability).isNotNull(), vector_to_array(F.col(probability))[1])
    return score if empty is None else F.coalesce(score, F.lit(float(empty)))


# Where the error function's series gives way to its continued fraction, and terms of each for full precision.
ERROR_TURN, SERIES_TERMS, FRACTION_TERMS = 3.0, 60, 200


def upper_error(z: Column) -> Column:
    """The complementary error function of a number that is not negative."""
    x = z * z
    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add_term(state: Column, n: Column) -> Column:
        term = state["term"] * 2.0 * x / (2 * n + 1)
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    series = F.aggregate(terms, start, add_term, lambda state: state["sum"])
    steps = F.sequence(F.lit(FRACTION_TERMS), F.lit(1), F.lit(-1))
    fraction = F.aggregate(steps, z, lambda below, k: z + k / 2.0 / below)
    scale = F.exp(-x) / F.sqrt(F.pi())
    return F.when(x < ERROR_TURN, 1.0 - 2.0 * scale * z * series).otherwise(scale / fraction)


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: a finite sum, since ``dof`` is whole; 1 where it is not positive."""
    x = statistic.cast("double") / 2.0
    dof = dof.cast("int")
    odd = dof % 2
    # Logarithms of the first term (power 0, or 1/2), then of each next one by the ratio of neighbours.
    first = F.when(odd == 1, F.log(x) / 2.0 - x - F.log(F.sqrt(F.pi()) / 2.0)).otherwise(-x)
    start = F.struct(first.alias("log"), F.lit(0.0).alias("sum"))

    def add_term(state: Column, i: Column) -> Column:
        return F.struct((state["log"] + F.log(x) - F.log(i + 1.0 + odd / 2.0)).alias("log"), (state["sum"] + F.exp(state["log"])).alias("sum"))

    powers = F.filter(F.sequence(F.lit(0), F.greatest(F.floor(dof / 2).cast("int") - 1, F.lit(0))), lambda i: i < F.floor(dof / 2))
    finite = F.aggregate(powers, start, add_term, lambda state: state["sum"])
    rest = F.when(odd == 1, upper_error(F.sqrt(x))).otherwise(0.0)
    return F.when((dof > 0) & (x > 0), F.least(finite + rest, F.lit(1.0))).otherwise(1.0)
