"""Session factory for scripts, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

APP_NAME = "cohortry"


def get_spark(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the web page off.

    On a cluster leave ``master`` unset and let spark-submit supply it together with
    ``spark.checkpoint.dir`` (see ``sources.scratch``). Keyword names use ``__`` for dots.
    """
    builder = (
        SparkSession.builder.appName(APP_NAME)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
