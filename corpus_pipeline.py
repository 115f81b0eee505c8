"""A corpus pipeline: toxic documents go, then exact and near copies; sources are mixed and packed.

Each stage reads what its predecessor kept. All but the last return the columns of
documents; the last returns the packed pieces. Between stages the table is written as
Parquet to the folder in ``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from cohortry.llm.common import table
from cohortry.llm.queries import toxicity_scorer
from cohortry.sources.scratch import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer of query 5 judges toxic go."""
    return toxicity.without_toxic(docs, toxicity_scorer(spark, sf_dir))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one_of_each(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays."""
    return near_dedup.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The toxicity scorer is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
