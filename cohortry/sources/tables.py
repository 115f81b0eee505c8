"""CSV and Parquet scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the price of one more pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def source_state(spark: SparkSession, *paths: str) -> int:
    """A number that changes when files under the paths come, go or are rewritten.

    It is summed over names, lengths and modification times of the files; none is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    mark = F.xxhash64("path", "length", "modificationTime") % 1_000_000_007
    return files.select(mark.alias("mark")).agg(F.coalesce(F.sum("mark"), F.lit(0))).first()[0]


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table; ``partition_by`` lets later filters skip whole files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV directory with one file per partition, for tables of any size."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file with a header. For small aggregates: the rows pass through one task."""
    write_csv(df.coalesce(1), path)
