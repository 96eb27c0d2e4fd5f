"""Session settings for tests, the bench and single-machine use.

On a cluster the caller passes its own session; nothing in the library depends on these values.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "cohortwise", memory: str | None = None) -> SparkSession:
    """A local session with adaptive execution, UTC timestamps and as many shuffle partitions as cores."""
    partitions = str(cpus) if str(cpus).isdigit() else str(os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory or os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.default.parallelism", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost planning time
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
