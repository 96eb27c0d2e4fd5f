"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import SMALL_KEYS, if_small


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _handed(sides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The smallest of each id and its neighbours, and the links with it beside them.

    The smallest ones are a table of their own, so that adaptive execution can split a centre with many links.
    """
    least = stage(sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "least")
    return least, sides.join(if_small(least, SMALL_KEYS), "u")


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in the links (a, b); root is the smallest id that can be reached.

    Two contractions in turn, until the links are stars: every id hands its larger neighbours to the smallest one
    it knows, then hands all that are left. Each is one aggregation and one join over the links.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        _, handed = _handed(_both_ways(edges))
        edges = stage(handed.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct(), "links")
        least, handed = _handed(edges)
        small = handed.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "links")
    ends = F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("root")), F.struct(F.col("v").alias("id"), F.col("v").alias("root")))
    return edges.select(F.explode(ends).alias("e")).groupBy("e.id").agg(F.min("e.root").alias("root"))
