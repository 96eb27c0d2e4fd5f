"""Gaussian kernel density curves as tables, by a fast Gauss transform with a proven error bound."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null

# Points per curve and how many bandwidths it reaches past the data.
GRID_POINTS = 200
CUT = 3.0
#: Width of a box of readings, in bandwidths.
BOX = 0.25
#: Largest error of a reading's share in a point, as a part of the kernel's height.
TOLERANCE = 1e-16


def reach_of(tolerance: float) -> float:
    """Bandwidths from a box's centre beyond which all kernels of the box are below ``tolerance``."""
    return BOX / 2 + math.sqrt(2 * math.log(1 / tolerance))


def terms_of(tolerance: float) -> int:
    """How many terms of the series keep its rest below ``tolerance``.

    With u the distance of a point and d of a reading from the centre of the reading's box, the kernel is
    exp(-u*u/2) * exp(-d*d/2) * exp(u*d). Cutting the last factor's series after p terms leaves at most
    exp(reach*a) * a**p / p! * max(u**p * exp(-u*u/2)) where a is half a box, and the maximum is at u*u = p.
    """
    a, p = BOX / 2, 1
    while math.exp(reach_of(tolerance) * a + p * math.log(a) - math.lgamma(p + 1) + p / 2 * (math.log(p) - 1)) > tolerance:
        p += 1
    return p


def _power(first: Column, factor: Column, times: int) -> Column:
    out = first
    for _ in range(times):
        out = out * factor
    return out


def density(
    df: DataFrame,
    columns: Sequence[str],
    by: str | None = None,
    groups: Sequence | None = None,
    points: int = GRID_POINTS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``series, field, point_no, x, density`` with Scott's bandwidth, per column and group.

    Readings are summed into boxes of a quarter of a bandwidth, each of which keeps a few moments; a box then adds
    to the points within its reach. A curve's boxes times the points near them are a constant number, so after the
    scan, whose sums are partial per task, the work does not grow with the rows. Infinite readings give no curve.
    """
    spark = df.sparkSession
    curves = [(g, c) for g in (groups if by else [None]) for c in columns]
    expr = {
        (g, c): nan_to_null(F.col(c) if by is None else F.when(F.col(by) == F.lit(g), F.col(c)))
        for g, c in curves
    }
    row = df.agg(
        *[F.count(expr[k]).alias(f"n{i}") for i, k in enumerate(curves)],
        *[F.stddev_samp(expr[k]).alias(f"s{i}") for i, k in enumerate(curves)],
        *[F.min(expr[k]).cast("double").alias(f"lo{i}") for i, k in enumerate(curves)],
        *[F.max(expr[k]).cast("double").alias(f"hi{i}") for i, k in enumerate(curves)],
    ).first()

    parts, specs = [], []
    for i, key in enumerate(curves):
        n, std = row[f"n{i}"], row[f"s{i}"]
        if n < 2 or not std or not math.isfinite(std):
            continue
        width = std * n ** (-1 / 5)
        start = row[f"lo{i}"] - CUT * width
        step = (row[f"hi{i}"] + CUT * width - start) / (points - 1)
        specs.append((i, str(key[0]) if by else "all", key[1], n, width, start, step))
        place = (expr[key].cast("double") - F.lit(start)) / F.lit(width)
        box = F.floor(place / BOX)
        d = place - (box + 0.5) * BOX
        weight = F.exp(-d * d / 2)
        parts.append(F.struct(F.lit(i).alias("curve"), box.alias("box"), d.alias("d"), weight.alias("weight")))
    curve_table = spark.createDataFrame(
        specs or [], "curve int, series string, field string, n long, width double, start double, step double"
    )
    if not parts:
        return curve_table.selectExpr("series", "field", "0 AS point_no", "0D AS x", "0D AS density")

    # places count bandwidths from the start of the curve
    tall = df.select(F.inline(F.array(*parts))).where(F.col("box").isNotNull())
    terms = range(terms_of(tolerance))
    moments = tall.groupBy("curve", "box").agg(
        *[(F.sum(_power(F.col("weight"), F.col("d"), k)) / math.factorial(k)).alias(f"m{k}") for k in terms]
    )
    placed = moments.join(F.broadcast(curve_table), "curve")  # a row per column and group
    centre, gap = (F.col("box") + 0.5) * BOX, F.col("step") / F.col("width")
    reach = F.lit(reach_of(tolerance))
    first = F.greatest(F.lit(0), F.ceil((centre - reach) / gap).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((centre + reach) / gap).cast("int"))
    touched = placed.withColumn("point_no", F.explode(F.when(first <= last, F.sequence(first, last))))
    u = F.col("point_no") * gap - centre
    series = F.lit(0.0)
    for k in reversed(terms):
        series = series * u + F.col(f"m{k}")
    sums = touched.groupBy("curve", "point_no").agg(F.sum(F.exp(-u * u / 2) * series).alias("mass"))
    grid = curve_table.withColumn("point_no", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    height = F.coalesce("mass", F.lit(0.0)) / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))
    return grid.join(sums, ["curve", "point_no"], "left").select(
        "series",
        "field",
        "point_no",
        (F.col("start") + F.col("point_no") * F.col("step")).alias("x"),
        height.alias("density"),
    )
