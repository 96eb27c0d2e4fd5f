"""Running totals and average ranks over the distinct values of many features.

Rows are first summed per (feature, value), so a value held by a third of the table is one row
afterwards. A feature with few distinct values is then ordered in one window partition. A feature with
many is cut into value buckets of bounded size, each ordered on its own, and the totals of the
earlier buckets are added as an offset.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import nan_to_null
from ..sources.staging import stage
from .shape import feature_rows

#: distinct values one ordering task may hold
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 20_000


def value_weights(
    df: DataFrame, features: Mapping[str, Column], weights: Mapping[str, Column]
) -> DataFrame:
    """``feature, value`` and the sum of every weight over the rows holding that value."""
    carried = df.select(
        *[nan_to_null(expr).alias(f"f{i}") for i, expr in enumerate(features.values())],
        *[expr.alias(name) for name, expr in weights.items()],
    )
    tall = feature_rows(
        carried,
        {name: F.col(f"f{i}") for i, name in enumerate(features)},
        [F.col(name) for name in weights],
    )
    return tall.groupBy("feature", "value").agg(*[F.sum(name).alias(name) for name in weights])


def distinct_estimates(df: DataFrame, features: Mapping[str, Column]) -> dict[str, int]:
    """A cheap sketch of how many distinct values each feature has, to choose a strategy by size."""
    names = list(features)
    row = df.agg(
        *[F.approx_count_distinct(features[n]).alias(f"d{i}") for i, n in enumerate(names)]
    ).first()
    return {n: row[f"d{i}"] for i, n in enumerate(names)}


def running_totals(
    table: DataFrame,
    weights: Sequence[str],
    distinct: Mapping[str, int],
    descending: bool = False,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Adds ``upto_<weight>``: the sum over this value and all values ordered before it."""
    bucket_rows = bucket_rows or BUCKET_ROWS
    order = F.col("value").desc() if descending else F.col("value").asc()
    if max(distinct.values(), default=0) <= bucket_rows:
        window = _running(Window.partitionBy("feature").orderBy(order))
        return table.withColumns({f"upto_{w}": F.sum(w).over(window).cast("double") for w in weights})

    table = stage(table, "value-weights")
    bucketed = _bucket(table, distinct, bucket_rows)
    spark = table.sparkSession
    totals = bucketed.groupBy("feature", "bucket").agg(*[F.sum(w).alias(f"t_{w}") for w in weights])
    rows = totals.collect()  # at most MAX_BUCKETS + 1 rows per feature
    offsets = _offsets(rows, weights, descending)
    prefix = spark.createDataFrame(
        offsets, "feature string, bucket int, " + ", ".join(f"o_{w} double" for w in weights)
    )
    window = _running(Window.partitionBy("feature", "bucket").orderBy(order))
    out = bucketed.join(F.broadcast(prefix), ["feature", "bucket"], "left")
    return out.withColumns(
        {f"upto_{w}": F.sum(w).over(window) + F.col(f"o_{w}") for w in weights}
    ).drop("bucket", *[f"o_{w}" for w in weights])


def _running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _bucket(table: DataFrame, distinct: Mapping[str, int], bucket_rows: int) -> DataFrame:
    """Cut every feature at quantiles of its distinct values, so no bucket is larger than the rest."""
    buckets = min(MAX_BUCKETS, max(2, -(-max(distinct.values()) * 2 // bucket_rows)))
    grid = [j / buckets for j in range(1, buckets)]
    cuts = {
        r["feature"]: sorted(set(r["cuts"]))
        for r in table.groupBy("feature")
        .agg(F.percentile_approx("value", grid, max(10_000, 10 * buckets)).alias("cuts"))
        .collect()
    }
    numbered = list(cuts)
    framed = table
    for i, feature in enumerate(numbered):
        framed = Bucketizer(
            inputCol="value",
            outputCol=f"b{i}",
            splits=[float("-inf"), *cuts[feature], float("inf")],
            handleInvalid="keep",
        ).transform(framed)
    bucket = F.lit(0)
    for i, feature in enumerate(numbered):
        bucket = F.when(F.col("feature") == feature, F.col(f"b{i}").cast("int")).otherwise(bucket)
    return framed.withColumn("bucket", bucket).drop(*[f"b{i}" for i in range(len(numbered))])


def _offsets(rows, weights: Sequence[str], descending: bool) -> list[tuple]:
    by_feature: dict[str, list] = {}
    for row in rows:
        by_feature.setdefault(row["feature"], []).append(row)
    out = []
    for feature, group in by_feature.items():
        before = [0.0] * len(weights)
        for row in sorted(group, key=lambda r: r["bucket"], reverse=descending):
            out.append((feature, row["bucket"], *before))
            before = [b + float(row[f"t_{w}"]) for b, w in zip(before, weights)]
    return out


def average_ranks(
    df: DataFrame, features: Mapping[str, Column], bucket_rows: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """``feature, value, n, avg_rank`` per distinct value, and the distinct-count estimates."""
    distinct = distinct_estimates(df, features)
    table = value_weights(df, features, {"n": F.lit(1)})
    ranked = running_totals(table, ["n"], distinct, bucket_rows=bucket_rows)
    rank = F.col("upto_n") - F.col("n") + (F.col("n") + F.lit(1)) / F.lit(2.0)
    return ranked.select("feature", "value", "n", rank.cast("double").alias("avg_rank")), distinct
