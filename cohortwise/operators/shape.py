"""Turning one-row aggregates into tidy tables, and putting levels in a declared order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def rows_of(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per entry of ``rows`` for every input row (used on one-row aggregates)."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def batched_rows(
    df: DataFrame, entries: Sequence[tuple[Sequence[Column], Sequence[Mapping[str, Column]]]], per_scan: int
) -> DataFrame:
    """``rows_of`` over the aggregates of ``(aggregates, rows)`` entries, ``per_scan`` entries at a time.

    One aggregate over very many expressions outgrows what the JVM compiles, and then every row is
    interpreted; another scan of the same few columns is cheaper.
    """
    out = None
    for start in range(0, len(entries), per_scan):
        part = entries[start : start + per_scan]
        one = df.agg(*[a for aggs, _ in part for a in aggs])
        table = rows_of(one, [row for _, rows in part for row in rows])
        out = table if out is None else out.unionByName(table)
    return out


def feature_rows(df: DataFrame, columns: Mapping[str, Column], extra: Sequence[Column] = ()) -> DataFrame:
    """``feature, value`` rows for values that are present. Only for plans that group by value next."""
    rows = F.array(
        *[F.struct(F.lit(name).alias("feature"), expr.alias("value")) for name, expr in columns.items()]
    )
    tall = df.select(*extra, F.inline(rows))
    return tall.where(F.col("value").isNotNull())


def reindex_levels(
    spark: SparkSession, grouped: DataFrame, column: str, levels: Sequence[str]
) -> DataFrame:
    """Exactly the given levels in the given order, with NULLs where the table has no such level.

    The level list is a few literals supplied by the caller; the grouped side has one row per level.
    """
    frame = spark.createDataFrame(
        [(number, level) for number, level in enumerate(levels, start=1)], f"level_no int, {column} string"
    )
    return frame.join(grouped, column, "left").orderBy("level_no")
