"""Attaching per-value results to rows by equality of a value, whatever its distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: rows of a lookup table that may be broadcast (about 5 MB at 24 bytes a row)
BROADCAST_ROWS = 200_000
#: a value held by more than this share of the rows is treated as hot
HOT_SHARE = 1 / 1000
_SPREAD = 997


def attach_by_value(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    result: str,
    output: str,
    lookup_rows: int,
    total: int,
) -> DataFrame:
    """Left-join ``lookup(value, n, <result>)`` on ``column``; ``n`` is how many rows hold the value.

    A lookup of checked size is broadcast. A larger one is split: the hot values (fewer than
    ``1 / HOT_SHARE`` of them can exist) are broadcast, the others meet their rows in a shuffle whose
    keys are all rare. Rows without a shuffle key are spread over the partitions.
    """
    if lookup_rows <= BROADCAST_ROWS:
        side = F.broadcast(lookup.select(F.col("value").alias("_key"), F.col(result).alias(output)))
        return df.join(side, F.col(column).cast("double") == F.col("_key"), "left").drop("_key")
    lookup = stage(lookup.select("value", "n", result), "lookup")  # read twice below
    is_hot = F.col("n") >= F.lit(total * HOT_SHARE)
    hot = F.broadcast(
        lookup.where(is_hot).select(F.col("value").alias("_hot"), F.col(result).alias("_hot_result"))
    )
    rest = lookup.where(~is_hot).select(
        F.col("value").alias("_cold"), F.lit(0).alias("_zero"), F.col(result).alias("_cold_result")
    )
    value = F.col(column).cast("double")
    marked = df.join(hot, value == F.col("_hot"), "left")
    marked = marked.withColumn("_key", F.when(F.col("_hot").isNull(), value))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD)).cast("int") + 1
    marked = marked.withColumn("_salt", F.when(F.col("_key").isNull(), spread).otherwise(0))
    joined = marked.join(
        rest, (F.col("_key") == F.col("_cold")) & (F.col("_salt") == F.col("_zero")), "left"
    )
    return joined.withColumn(output, F.coalesce("_hot_result", "_cold_result")).drop(
        "_hot", "_hot_result", "_key", "_salt", "_cold", "_zero", "_cold_result"
    )
