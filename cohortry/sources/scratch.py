"""Shared scratch space named by the cluster in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cohortry.sources.tables import write_table


def scratch_root(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder,
    which goes when the process ends.
    On a cluster a missing setting is an error, since executors share no local disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="cohortry-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a table can still be read there; the folder's owner may have cleared it."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """The table written once to the scratch folder and read back.

    It cuts the lineage: later scans read columns from shared storage, and an executor
    lost afterwards costs nothing that has to be recomputed. ``partition_by`` lets scans
    of one part skip the files of the others.
    """
    path = scratch_path(df.sparkSession, name)
    write_table(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
