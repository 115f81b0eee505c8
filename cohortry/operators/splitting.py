"""Stored train/test split and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.expressions import count_where, key_slot

SPLIT_COLUMN = "Partition"
TRAINING = "Training"
TESTING = "Testing"
SLOTS = 10_000


def stable_split(
    df: DataFrame, key: str, fraction: float = 0.7, seed: int | None = None, out: str = SPLIT_COLUMN
) -> DataFrame:
    """Training or Testing by the slot of the key's md5; no shuffle, no random state."""
    training = key_slot(key, SLOTS, seed) < int(round(fraction * SLOTS))
    return df.withColumn(out, F.when(training, TRAINING).otherwise(TESTING))


def take_split(df: DataFrame, name: str, column: str = SPLIT_COLUMN) -> DataFrame:
    return df.where(F.col(column) == name)


def class_weights(train: DataFrame, label: str, mode: str = "balanced") -> DataFrame:
    """``label, n_rows, weight`` for the labels 0 and 1, from one aggregation.

    ``balanced`` gives each class ``n / (2 n_class)``; an absent class counts as one row.
    ``ratio`` gives positives the larger class count over the smaller and negatives 1.
    """
    totals = train.agg(
        count_where(F.col(label) == 0).alias("neg"), count_where(F.col(label) == 1).alias("pos")
    )
    neg, pos = F.greatest("neg", F.lit(1)), F.greatest("pos", F.lit(1))
    if mode == "balanced":
        weights = ((neg + pos) / (2.0 * neg), (neg + pos) / (2.0 * pos))
    elif mode == "ratio":
        both = (F.col("neg") > 0) & (F.col("pos") > 0)
        ratio = F.greatest(neg, pos) / F.least(neg, pos)
        weights = (F.lit(1.0), F.when(both, ratio).otherwise(1.0))
    else:
        raise ValueError(f"unknown weight mode {mode!r}")
    rows = [
        F.struct(F.lit(value).alias("label"), F.col(n).alias("n_rows"), weight.alias("weight"))
        for value, n, weight in zip((0, 1), ("neg", "pos"), weights)
    ]
    return totals.select(F.inline(F.array(*rows)))


def apply_weights(df: DataFrame, weights: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Add the fitted weights (two numbers, inlined as literals)."""
    fitted = {row["label"]: row["weight"] for row in weights.collect()}
    return df.withColumn(out, F.when(F.col(label) == 1, fitted[1]).otherwise(fitted[0]))
