"""Helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.sources.tables import read_table

# White space between words, and words, as the contracts define them.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
SLICE_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    """Words of a whole text; null counts as empty."""
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("bigint")


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package. A cluster gets it by ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, object]], schema: str | StructType
) -> DataFrame:
    """Apply ``work`` to slices of every Arrow batch; it returns columns in the order of ``schema``.

    A slice has at most ``SLICE_ROWS`` rows, which bounds what a worker holds as Python objects. Arrow keeps nullable integers as they are, which pandas would turn into doubles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                columns = work(batch.slice(at, SLICE_ROWS))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def split_key(groups: int, *columns: str) -> Column:
    """A share number in [0, groups) that depends on the row's values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(groups)).cast("int")
