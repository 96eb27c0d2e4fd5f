"""Exact quantiles of many expressions at once, without collecting a column in one task.

``percentile`` keeps a value-to-count map, so it is used only while the measured number of distinct
values is small. Beyond that the wanted ranks are narrowed down: a sketch proposes cut points, one
counting scan tells exactly which interval between two cut points holds each rank, and only those
intervals are looked at again. No scan shuffles more than interval counts until the last one, which
moves just the values of the final, small intervals.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import interval_number, nan_to_null

#: values, summed over all expressions, up to which ``percentile`` is used
MAP_LIMIT = 100_000
#: rows an interval may hold before it is narrowed again
PICK_LIMIT = 4_000_000
#: size of the sketch that proposes cut points, and how far around a rank they are asked for
SKETCH_SIZE = 32_768
MARGIN = 5e-4
#: cut points, at most, per interval that is narrowed again
GRID = 1024
#: rank resolution of ``mode="approx"``
ACCURACY = 10_000
#: cut points up to which a value's interval is found by comparisons in generated code
TREE_CUTS = 32
#: group values a grouped fit accepts; every one is fitted beside the others in the same scan
MAX_GROUPS = 32


@dataclass(frozen=True)
class Fit:
    """Number of present values and the value at every asked probability (None without values)."""

    count: int
    values: list[float | None]


def fit_quantiles(
    df: DataFrame,
    specs: Mapping[str, tuple[Column, Sequence[float]]],
    mode: str = "exact",
    accuracy: int = ACCURACY,
    map_limit: int | None = None,
    pick_limit: int | None = None,
) -> dict[str, Fit]:
    """Linear-interpolated quantiles for every ``name -> (expression, probabilities)``."""
    if mode not in ("exact", "approx"):
        raise ValueError(f"unknown quantile mode: {mode}")
    map_limit = MAP_LIMIT if map_limit is None else map_limit
    pick_limit = PICK_LIMIT if pick_limit is None else pick_limit
    names = list(specs)
    probs = [list(specs[name][1]) for name in names]
    values = df.select(*[nan_to_null(specs[name][0]).alias(f"v{i}") for i, name in enumerate(names)])

    if mode == "approx":
        row = values.agg(
            *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(names))],
            *[
                F.percentile_approx(f"v{i}", [float(p) for p in ps], accuracy).alias(f"p{i}")
                for i, ps in enumerate(probs)
            ],
        ).first()
        return {n: Fit(row[f"n{i}"], list(row[f"p{i}"] or [None] * len(probs[i]))) for i, n in enumerate(names)}

    counts, cuts = _sketch(values, probs)
    if not any(counts):
        found = [[None] * len(ps) for ps in probs]
    elif sum(counts) <= map_limit:
        row = values.agg(
            *[
                F.percentile(f"v{i}", F.array(*[F.lit(float(p)) for p in ps])).alias(f"p{i}")
                for i, ps in enumerate(probs)
            ]
        ).first()
        found = [list(row[f"p{i}"] or [None] * len(probs[i])) for i in range(len(names))]
    else:
        found = _narrow(values, counts, probs, cuts, pick_limit)
    return {name: Fit(counts[i], found[i]) for i, name in enumerate(names)}


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], mode: str = "exact", **limits
) -> dict[str, Fit]:
    return fit_quantiles(df, {c: (F.col(c), probs) for c in columns}, mode, **limits)


def group_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: str,
    groups: Sequence | None = None,
    mode: str = "exact",
    **limits,
) -> dict[tuple, Fit]:
    """Quantiles per group value, ``(group, column) -> Fit``. A NULL group is left out."""
    if groups is None:
        groups = group_values(df, by)
    specs = {
        f"{g}\x00{c}": (F.when(F.col(by) == F.lit(g), F.col(c)), probs) for g in groups for c in columns
    }
    fits = fit_quantiles(df, specs, mode, **limits)
    return {(g, c): fits[f"{g}\x00{c}"] for g in groups for c in columns}


def group_values(df: DataFrame, by: str) -> list:
    """The distinct group values, checked against ``MAX_GROUPS`` before they reach the driver."""
    rows = df.select(by).where(F.col(by).isNotNull()).distinct().limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{by} has more than {MAX_GROUPS} values; group a banded column instead")
    return sorted(r[0] for r in rows)


def quantile_edges(df: DataFrame, column: str, bands: int, mode: str = "exact", **limits) -> list[float]:
    """Distinct quantile edges of ``bands`` equally filled bands; ties can make them fewer."""
    probs = [i / bands for i in range(bands + 1)]
    fit = fit_quantiles(df, {column: (F.col(column), probs)}, mode, **limits)[column]
    return sorted({v for v in fit.values if v is not None})


def quantile_band(column: Column, edges: Sequence[float]) -> Column:
    """1-based band of right-closed quantile edges, the minimum included in the first band."""
    return interval_number(column, edges)


# --- narrowing -------------------------------------------------------------------------------


def _interpolate(low: float, high: float, fraction: float) -> float:
    return low if low == high else low + (high - low) * fraction


def _narrow(
    values: DataFrame,
    counts: list[int],
    probs: list[list[float]],
    cuts: dict[int, list[float]],
    pick_limit: int,
) -> list[list[float | None]]:
    wanted: dict[int, set[int]] = {}
    for i, ps in enumerate(probs):
        if counts[i]:
            spots = [p * (counts[i] - 1) for p in ps]
            wanted[i] = {math.floor(s) for s in spots} | {math.ceil(s) for s in spots}
    known: dict[tuple[int, int], float] = {}
    while True:
        framed = _with_intervals(values, cuts)
        pending = _locate(wanted, cuts, _interval_sizes(framed, cuts), known)
        if not pending:
            break
        wide = {key: size for key, (size, _) in pending.items() if size > pick_limit}
        proposed = _propose(framed, list(wide), _grid_for(wide, pick_limit)) if wide else {}
        fresh = {i: {v for v in found if math.isfinite(v)} - set(cuts[i]) for i, found in proposed.items()}
        if not any(fresh.values()):  # every wanted interval is small, or holds nothing that could split it
            known.update(_pick(framed, pending))
            break
        cuts = _next_cuts(pending, cuts, fresh)

    out: list[list[float | None]] = []
    for i, ps in enumerate(probs):
        if not counts[i]:
            out.append([None] * len(ps))
            continue
        spots = [p * (counts[i] - 1) for p in ps]
        out.append(
            [_interpolate(known[i, math.floor(s)], known[i, math.ceil(s)], s - math.floor(s)) for s in spots]
        )
    return out


def _grid_for(wide: Mapping[tuple[int, int], int], pick_limit: int) -> int:
    """Cut points that make the widest interval small, with room for the sketch's error."""
    return max(8, min(GRID, 4 * math.ceil(max(wide.values()) / max(pick_limit, 1))))


def _next_cuts(pending, cuts: dict[int, list[float]], fresh: dict[int, set[float]]) -> dict[int, list[float]]:
    """The ends of the intervals that still hold a wanted rank, and the new cuts; all others have served."""
    ends: dict[int, set[float]] = {}
    for i, interval in pending:  # interval 2k lies between cuts k - 1 and k
        ends.setdefault(i, set()).update(cuts[i][max(interval // 2 - 1, 0) : interval // 2 + 1])
    return {i: sorted(near | fresh.get(i, set())) for i, near in ends.items()}


def _sketch(values: DataFrame, probs: list[list[float]]) -> tuple[list[int], dict[int, list[float]]]:
    """Counts, and sketched values just below and above every asked probability, from one scan."""
    asked = [
        sorted({min(1.0, max(0.0, p + side)) for p in ps for side in (-MARGIN, MARGIN)}) for ps in probs
    ]
    aggs = []
    for i, ps in enumerate(asked):
        sketch = F.kll_sketch_agg_double(f"v{i}", SKETCH_SIZE)
        n = F.count(f"v{i}")
        near = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(p) for p in ps]))
        aggs += [n.alias(f"n{i}"), F.when(n > 0, near).alias(f"c{i}")]
    row = values.agg(*aggs).first()
    counts = [row[f"n{i}"] for i in range(len(probs))]
    cuts = {
        i: sorted({v for v in row[f"c{i}"] if math.isfinite(v)}) for i, count in enumerate(counts) if count
    }
    return counts, cuts


def _locate(wanted, cuts, sizes, known) -> dict[tuple[int, int], tuple[int, list[tuple[int, int]]]]:
    """Interval of every unresolved rank. Odd intervals are a single cut value and settle the rank."""
    pending: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    for i in cuts:
        ranks = wanted[i]
        order = sorted(sizes[i])
        ends, total = [], 0
        for interval in order:
            total += sizes[i][interval]
            ends.append(total)
        for rank in ranks:
            if (i, rank) in known:
                continue
            at = bisect_right(ends, rank)
            interval = order[at]
            if interval % 2:
                known[i, rank] = cuts[i][interval // 2]
            else:
                before = ends[at - 1] if at else 0
                size, ranked = pending.setdefault((i, interval), (sizes[i][interval], []))
                ranked.append((rank, rank - before))
    return pending


def _with_intervals(values: DataFrame, cuts: dict[int, list[float]]) -> DataFrame:
    """Adds ``s<i>``, the interval of ``v<i>``: 2k lies before cut k, 2k+1 is cut k itself."""
    cutting = [i for i in cuts if len(cuts[i]) > TREE_CUTS]
    framed = values
    if cutting:
        framed = Bucketizer(
            inputCols=[f"v{i}" for i in cutting],
            outputCols=[f"b{i}" for i in cutting],
            splitsArray=[[float("-inf"), *cuts[i], float("inf")] for i in cutting],
            handleInvalid="keep",
        ).transform(values)
    spots = []
    for i in cuts:
        value = F.col(f"v{i}")
        if i in cutting:
            bucket = F.col(f"b{i}").cast("int")
            # one text that is folded to one constant, not an expression for each cut
            ends = F.split(F.lit(",".join(map(repr, cuts[i]))), ",").cast("array<double>")
            here = F.get(ends, bucket - 1)
            interval = F.when(here == value, 2 * bucket - 1).otherwise(2 * bucket)
        else:
            interval = _tree(value, cuts[i], 0)
        spots.append(F.when(value.isNotNull(), interval).otherwise(-1).alias(f"s{i}"))
    return framed.select(*[f"v{i}" for i in cuts], *spots)


def _interval_sizes(framed: DataFrame, cuts: dict[int, list[float]]) -> dict[int, dict[int, int]]:
    """Rows per interval of every item, counted over plain integer codes."""
    bases, base = {}, 0
    for i in cuts:
        bases[i] = base
        base += 2 * len(cuts[i]) + 2
    codes = F.array(*[F.col(f"s{i}") + F.lit(bases[i] + 1) for i in cuts])
    rows = framed.select(F.explode(codes).alias("code")).groupBy("code").count().collect()
    starts = list(bases.values())
    items = list(bases)
    sizes: dict[int, dict[int, int]] = {i: {} for i in cuts}
    for row in rows:
        item = items[bisect_right(starts, row["code"]) - 1]
        interval = row["code"] - bases[item] - 1
        if interval >= 0:
            sizes[item][interval] = row["count"]
    return sizes


def _tree(value: Column, cuts: list[float], offset: int) -> Column:
    """The interval number by halving the cut points."""
    if not cuts:
        return F.lit(2 * offset)
    middle = len(cuts) // 2
    cut = F.lit(cuts[middle])
    return (
        F.when(value < cut, _tree(value, cuts[:middle], offset))
        .when(value > cut, _tree(value, cuts[middle + 1 :], offset + middle + 1))
        .otherwise(F.lit(2 * (offset + middle) + 1))
    )


def _only(framed: DataFrame, keys: Sequence[tuple[int, int]]) -> DataFrame:
    """``item, interval, value`` rows of the given intervals; rows outside all of them go first."""
    by_item: dict[int, list[int]] = {}
    for item, interval in keys:
        by_item.setdefault(item, []).append(interval)
    inside = {i: F.col(f"s{i}").isin(intervals) for i, intervals in by_item.items()}
    condition = F.lit(False)
    for test in inside.values():
        condition = condition | test
    rows = [
        F.struct(
            F.lit(i).alias("item"), F.col(f"s{i}").alias("interval"), F.when(test, F.col(f"v{i}")).alias("value")
        )
        for i, test in inside.items()
    ]
    return framed.where(condition).select(F.inline(F.array(*rows))).where(F.col("value").isNotNull())


def _propose(framed: DataFrame, keys: Sequence[tuple[int, int]], steps: int) -> dict[int, set[float]]:
    grid = F.array(*[F.lit(j / steps) for j in range(steps + 1)])
    sketch = F.kll_sketch_agg_double("value", 4 * GRID)
    rows = (
        _only(framed, keys)
        .groupBy("item", "interval")
        .agg(F.kll_sketch_get_quantile_double(sketch, grid).alias("grid"))
        .collect()
    )
    found: dict[int, set[float]] = {}
    for row in rows:
        found.setdefault(row["item"], set()).update(row["grid"])
    return found


def _pick(framed: DataFrame, pending: dict) -> dict[tuple[int, int], float]:
    """The values at the wanted ranks, found by running counts inside their small intervals."""
    spark = framed.sparkSession
    # a text of numbers: rows handed over from Python would start a worker for each task
    asked = spark.sql(
        "SELECT * FROM VALUES "
        + ", ".join(f"({i}, {at}, {rank}L, {local}L)" for (i, at), (_, pairs) in pending.items() for rank, local in pairs)
        + " AS asked(item, interval, rank, local)"
    )
    order = Window.partitionBy("item", "interval").orderBy("value")
    upto = F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (
        _only(framed, list(pending))
        .groupBy("item", "interval", "value")
        .count()
        .withColumn("upto", upto)
    )
    rows = (
        ranked.join(F.broadcast(asked), ["item", "interval"])
        .where((F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("count")))
        .select("item", "rank", "value")
        .collect()
    )
    return {(r["item"], r["rank"]): r["value"] for r in rows}
