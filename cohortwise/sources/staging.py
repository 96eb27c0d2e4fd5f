"""Intermediate tables in the shared folder of the session.

A staged table is an ordinary Parquet folder: it outlives an executor, later scans read only the
columns they need, and the lineage behind it is cut.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def staging_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="cohortwise-")
    return _local_root


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, removed by Hadoop when the application ends."""
    base = f"{staging_root(spark)}/cohortwise-{spark.sparkContext.applicationId}"
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage(df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once, compressed by ``codec`` or as the session says, and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(_partition_last(df, partition_by)).parquet(path)


def _partition_last(df: DataFrame, partition_by: str | None):
    if not partition_by:
        return df.schema
    return df.select(*[c for c in df.columns if c != partition_by], partition_by).schema
