"""Scoring tables as they arrive. A scorer keeps no state, so the batch function serves the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..learners.artifact import Scorer


def arriving(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def score_stream(stream: DataFrame, scorer: Scorer, sink: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append scored records to a Parquet folder.

    ``once`` handles what is there and stops. File sink and checkpoint make a restart after a lost
    driver or executor continue without duplicates.
    """
    writer = scorer.score(stream).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
