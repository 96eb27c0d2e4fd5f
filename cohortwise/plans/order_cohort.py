"""The screening cohort over order tables: one labelled record per order.

Line items are summed per order key before they meet the orders, and orders are collapsed on the same
key, so the join finds both sides already partitioned and a hot key arrives as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, Field
from ..operators.clean import zeros_to_missing
from ..operators.features import Derivations

KEY = "pid"
TARGET = "outcome"

CONTRACT = Contract(
    features=(
        Field("n_lines", "int", 0, 10, unit="count", definition="Lines of the order"),
        Field("max_price", "float", 900.0, 100000.0, 2, "money", "Highest line price", False),
        Field("min_disc", "float", 0.01, 0.1, 2, "share", "Lowest discount", False),
        Field("min_tax", "float", 0.01, 0.08, 2, "share", "Lowest tax", False),
        Field("qty", "float", 1.0, 300.0, 1, "pieces", "Pieces ordered", False),
        Field("total", "float", 1000.0, 450000.0, 2, "money", "Order total"),
    ),
    target=Field(TARGET, "binary", positive_rate=0.329, definition="1 when the order is finished"),
    key=KEY,
)

DERIVATIONS = Derivations(
    bands={
        "price_band": ("max_price", (30000.0, 50000.0, 60000.0), ("Low", "Normal", "High", "Extreme")),
        "qty_band": ("qty", (60.5, 120.0, 600.0), ("Few", "Some", "Many", "Flood")),
    },
    ratios={"qty_per_line": ("qty", "n_lines")},
    products={"price_tax": ("max_price", "min_tax", 405.0)},
    score="risk_score",
    score_tests={"max_price": 50000, "qty": 120, "total": 250000.0, "n_lines": 5},
)


def order_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pid, n_lines, max_price, min_disc, min_tax, qty, total, outcome."""
    lines = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy(F.col("l_orderkey").alias(KEY))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.max("l_extendedprice").alias("price"),
            F.min("l_discount").alias("disc"),
            F.min("l_tax").alias("tax"),
            F.sum("l_quantity").alias("pieces"),
        )
    )
    orders = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .groupBy(F.col("o_orderkey").alias(KEY))
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max("o_totalprice").alias("total"),
            F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias(TARGET),
        )
    )
    joined = orders.join(lines, KEY, "left")
    zero = F.lit(0.0)
    return joined.select(
        KEY,
        (F.coalesce("lines", F.lit(0)) * F.col("copies")).cast("bigint").alias("n_lines"),
        F.coalesce("price", zero).alias("max_price"),
        F.coalesce("disc", zero).alias("min_disc"),
        F.coalesce("tax", zero).alias("min_tax"),
        (F.coalesce("pieces", zero) * F.col("copies")).alias("qty"),
        "total",
        TARGET,
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort with its disguised zeros as NULL."""
    return zeros_to_missing(order_cohort(spark, sf_dir), CONTRACT.disguised)
