"""Moments of all columns and of all pairs of columns from one scan, whatever the number of columns.

For pairs, each task keeps, for the rows it sees, the matrices of joint counts, sums and products of centred values over the
rows where both columns of a pair are present, and hands them on as one row per pair when it ends. Matrix products
do the work, so a hundred columns are one scan and one small aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose matrices are held at once.
BLOCK_ROWS = 4096
_SUMS = ("n", "sum_i", "square_i", "sum_j", "square_j", "product")


def _blocks(batch: pa.RecordBatch, centres: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(start, BLOCK_ROWS)
        columns = [part.column(k).to_numpy(zero_copy_only=False) for k in range(len(centres))]
        yield np.column_stack(columns).astype(float) - centres


def _moment_rows(centres: np.ndarray):
    width = len(centres)

    def run(batches):
        sums = np.zeros((4, width, width))
        low, high = np.full((width, width), np.inf), np.full((width, width), -np.inf)
        for batch in batches:
            for x in _blocks(batch, centres):
                have = ~np.isnan(x)
                known, there = np.where(have, x, 0.0), have.astype(float)
                sums += [there.T @ there, known.T @ there, (known * known).T @ there, known.T @ known]
                for j in range(width):  # values of every column where column j is present
                    joint = x[have[:, j]]
                    if len(joint):
                        low[:, j] = np.fmin(low[:, j], np.fmin.reduce(joint, axis=0))
                        high[:, j] = np.fmax(high[:, j], np.fmax.reduce(joint, axis=0))
        n, first, square, product = sums
        i, j = (a.ravel() for a in np.indices((width, width)))
        found = [n, first, square, first.T, square.T, product, low, high, low.T, high.T]
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(np.ascontiguousarray(m).ravel()) for m in found]]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", *_SUMS, "low_i", "high_i", "low_j", "high_j"])

    return run


def pair_moments(numbers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, sums and products of centred values, extremes) of every ordered pair of numeric columns.

    The centres are the columns' means; they only keep the sums small.
    """
    means = numbers.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    finite = [m if m is not None and np.isfinite(m) else 0.0 for m in means]
    kept = ", ".join(f"{c} double" for c in (*_SUMS, "low_i", "high_i", "low_j", "high_j"))
    parts = numbers.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(_moment_rows(np.array(finite)), f"i int, j int, {kept}")
    return parts.groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in _SUMS], *[f(c).alias(c) for c, f in (("low_i", F.min), ("high_i", F.max), ("low_j", F.min), ("high_j", F.max))]
    )


def pearson(numbers: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    """(row_field, column_field, correlation) of every ordered pair; NULL where a column does not vary."""
    n = F.col("n")
    covariance = F.col("product") - F.col("sum_i") * F.col("sum_j") / n
    spread = [F.col(f"square_{s}") - F.col(f"sum_{s}") * F.col(f"sum_{s}") / n for s in "ij"]
    varies = (F.col("low_i") < F.col("high_i")) & (F.col("low_j") < F.col("high_j"))
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(covariance / F.sqrt(spread[0] * spread[1]))
    names = F.array(*[F.lit(c) for c in columns])
    return pair_moments(numbers, columns).select(
        names[F.col("i")].alias("row_field"), names[F.col("j")].alias("column_field"),
        F.when(varies, F.round(F.nanvl(r, F.lit(None).cast("double")), digits)).alias("correlation"),
    )


_COLUMN_SUMS = ("n", "s1", "s2", "s3", "s4", "zeros", "inside")
_COLUMN_EDGES = (("low", F.min), ("high", F.max), ("low_inside", F.min), ("high_inside", F.max))


def _column_rows(centres: np.ndarray, floors: np.ndarray, ceilings: np.ndarray):
    groups, width = centres.shape

    def run(batches):
        seen = np.zeros(groups, dtype=np.int64)
        sums = np.zeros((len(_COLUMN_SUMS), groups, width))
        edges = np.full((len(_COLUMN_EDGES), groups, width), np.nan)
        for batch in batches:
            for block in _blocks(batch, np.zeros(width + 1)):
                for g in np.unique(block[:, width]).astype(int):
                    x = block[block[:, width] == g, :width]
                    have = ~np.isnan(x)
                    d = np.where(have, x - centres[g], 0.0)
                    within = (x >= floors[g]) & (x <= ceilings[g])
                    inner = np.where(within, x, np.nan)
                    seen[g] += len(x)
                    square = d * d
                    for k, part in enumerate((have, d, square, square * d, square * square, x == 0, within)):
                        sums[k, g] += part.sum(axis=0)
                    for k, (part, pick) in enumerate(((x, np.fmin), (x, np.fmax), (inner, np.fmin), (inner, np.fmax))):
                        edges[k, g] = pick(edges[k, g], pick.reduce(part, axis=0))
        g, i = (a.ravel() for a in np.indices((groups, width)))
        whole = [pa.array(g, pa.int32()), pa.array(i, pa.int32()), pa.array(seen[g], pa.int64())]
        arrays = [pa.array(m.ravel(), from_pandas=True) for m in (*sums, *edges)]
        yield pa.RecordBatch.from_arrays([*whole, *arrays], names=["g", "i", "seen", *_COLUMN_SUMS, *[c for c, _ in _COLUMN_EDGES]])

    return run


def column_moments(numbers: DataFrame, columns: Sequence[str], centres, floors, ceilings, entries: DataFrame, group=None) -> DataFrame:
    """``entries`` with seen, n, s1 to s4, zeros, inside, low, high, low_inside, high_inside of their group and column.

    ``entries`` is a small table with a row per group ``g`` and column ``i`` and whatever else is known of them. Its
    rows join the tasks' rows in the aggregate, so an entry without any row of ``numbers`` is there too.
    ``centres``, ``floors`` and ``ceilings`` hold a row per group and a value per column: ``s1`` to ``s4`` are sums of
    powers of the distance to the centre, ``inside`` counts values from floor to ceiling. ``group`` is a column with
    the row of a group, NULL for rows of none; without it all rows are group 0. ``numbers`` holds doubles, NaN as NULL.
    """
    shape = (-1, len(columns))
    limits = [np.array(part, dtype=float).reshape(shape) for part in (centres, floors, ceilings)]
    rows = numbers.select(*[F.col(c).cast("double") for c in columns], (F.lit(0) if group is None else group).cast("double").alias("_group"))
    kept = ", ".join(f"{c} double" for c in (*_COLUMN_SUMS, *[c for c, _ in _COLUMN_EDGES]))
    parts = rows.where(F.col("_group").isNotNull()).mapInArrow(_column_rows(*limits), f"g int, i int, seen long, {kept}")
    known = [c for c in entries.columns if c not in ("g", "i")]
    none = {"seen": F.lit(0), **{c: F.lit(0.0) for c in _COLUMN_SUMS}}
    both = parts.unionByName(entries.withColumns(none), allowMissingColumns=True)
    return both.groupBy("g", "i").agg(
        *[F.max(c).alias(c) for c in known], F.sum("seen").alias("seen"),
        *[F.sum(c).alias(c) for c in _COLUMN_SUMS], *[f(c).alias(c) for c, f in _COLUMN_EDGES],
    ).sortWithinPartitions("g", "i")
