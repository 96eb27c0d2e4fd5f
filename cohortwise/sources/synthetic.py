"""Tables generated from a contract, one row per key, the same on every cluster and every retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, Field
from ..functions.hashing import hash_unit

# Default size and seed of a generated table.
ROWS = 500
SEED = 42


def synthesize(keys: DataFrame, key: str, contract: Contract, seed: int = SEED) -> DataFrame:
    """A record for every key, drawn uniformly from the declared ranges and domains."""
    columns = [draw(F.col(key), f, seed).alias(f.name) for f in (*contract.features, contract.target)]
    return keys.select(F.col(key), *columns)


def synthetic_table(spark: SparkSession, contract: Contract, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    key = contract.key or "row_no"
    return synthesize(spark.range(rows).withColumnRenamed("id", key), key, contract, seed)


def draw(key: Column, item: Field, seed: int) -> Column:
    u = hash_unit(key, seed, item.name)
    if item.kind == "categorical":
        domain = F.array(*[F.lit(v) for v in item.values])
        return F.element_at(domain, F.floor(u * len(item.values)).cast("int") + 1)
    if item.kind == "binary":
        return (u < F.lit(item.positive_rate)).cast("int")
    value = F.lit(float(item.low)) + u * F.lit(float(item.high) - float(item.low))
    return value.cast("bigint") if item.kind == "int" else F.round(value, item.decimals)
