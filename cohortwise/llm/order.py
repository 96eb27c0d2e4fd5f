"""Places of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import if_small

#: Rows that one task orders, on average.
CELL_ROWS = 20_000


def ranked(df: DataFrame, group: str, order: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with ``at``, the place of the row in its group (from 0), and ``n``, the rows of the group.

    Ranges of (group, order) are cut first, so that a hot group is spread over many tasks; the places come from
    row counts per range and the order inside it. ``df`` is a staged table: it is read several times. The group
    column holds no null; nulls come first in the order, and rows alike in it are dealt out in any order.
    """
    rows = df.count()
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [group, *order, "__tie"]
    cells = tied.repartitionByRange(max(1, -(-rows // cell_rows)), *keys).withColumn("__cell", F.spark_partition_id())
    cells = stage(cells, "ranges")
    counts = cells.groupBy(group, "__cell").agg(F.count(F.lit(1)).alias("__own"))
    whole = Window.partitionBy(group)  # one row per range
    earlier = whole.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, "__cell", F.coalesce(F.sum("__own").over(earlier), F.lit(0)).alias("__before"), F.sum("__own").over(whole).alias("n")
    )
    counts = if_small(stage(counts, "ranges"))
    inside = Window.partitionBy(group, "__cell").orderBy(*order, "__tie")
    placed = cells.join(counts, [group, "__cell"]).withColumn("at", F.col("__before") + F.row_number().over(inside) - 1)
    return placed.drop("__tie", "__cell", "__before")
