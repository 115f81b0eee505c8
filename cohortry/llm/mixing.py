"""Mixing sources to target weights by repetition rates.

Tokens are aggregated per source, targets come from the weights, and a source's rate is
target / size. A document is taken floor(rate) times, plus once more when its hash, a
number in [0, 1) that depends on the seed and the doc_id alone, lies below the fraction.
Each source uses the seed, of ``SEEDS`` candidates, whose total comes nearest its target.

Defined results: null text has size 0; sources go by code point, null last; a source of
size 0 has target 0; documents that repeat a doc_id get the same number of copies; an
empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import word_count
from cohortry.sources.scratch import stored

# Fixed values of the contract: weights of the sources in turn, and the largest rate.
WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEEDS = 16


def draw(seed: Column | int, id_column: str = "doc_id") -> Column:
    """A number in [0, 1) with 52 random bits, from seed and identifier."""
    text = F.concat(F.lit(seed).cast("string") if isinstance(seed, int) else seed.cast("string"), F.lit(":"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """Per source: source, source_size, target. The targets add up to all tokens.

    Sources fill up in the order of cap / weight: those whose cap lies below the common
    level stay at the cap, the others share what is left. One row per source passes the
    windows, never a document.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ordered = per_source.select("*", weight.cast("bigint").alias("weight"), (F.col("source_size") * max_rate).alias("cap"))
    ordered = ordered.withColumn("level_to_cap", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("level_to_cap", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    sharing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ordered = ordered.withColumn("level", left / sharing)
    open_level = F.max(F.when(F.col("level_to_cap") > F.col("level"), F.col("level"))).over(everything)
    target = F.least(F.col("weight") * open_level, F.col("cap").cast("double"))
    return ordered.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seeds: int = SEEDS) -> DataFrame:
    """Per source: source_size, target, whole copies, fraction of one more, seed."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = targets(sizes, weights, max_rate).withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    goals = stored(goals.withColumn("part", F.col("rate") - F.col("whole")).drop("rate"), "mix-goals")
    drawn = _with_source(sizes, goals.select("source", "part"))
    sums = [F.sum(F.when(draw(s) < F.col("part"), F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(seeds)]
    totals = drawn.groupBy("source").agg(*sums)
    missed = [
        F.struct(F.abs(F.col("whole") * F.col("source_size") + F.col(f"s{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed"))
        for s in range(seeds)
    ]
    best = F.least(*missed) if seeds > 1 else missed[0]
    return _with_source(goals, totals).withColumn("seed", best["seed"]).select("source", "source_size", "target", "whole", "part", "seed")


def _with_source(left: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join on the source, null included; Spark broadcasts the side per source by its size."""
    right = per_source.withColumnRenamed("source", "__source")
    return left.join(right, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def copies() -> Column:
    return F.col("whole") + F.when(draw(F.col("seed")) < F.col("part"), 1).otherwise(0)


def sizes_of(docs: DataFrame) -> DataFrame:
    return stored(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    sizes = sizes_of(docs)
    planned = _with_source(sizes, rates(sizes, **options)).withColumn("copies", copies())
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    per_source = rates(sizes_of(docs), **options).select(
        F.col("source").alias("__source"), F.col("whole").alias("__whole"), F.col("part").alias("__part"), F.col("seed").alias("__seed")
    )
    joined = docs.join(per_source, F.col("source").eqNullSafe(F.col("__source")))
    times = F.col("__whole") + F.when(draw(F.col("__seed")) < F.col("__part"), 1).otherwise(0)
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*docs.columns)
