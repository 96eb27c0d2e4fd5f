"""Rank-based statistics: the two-sample rank-sum test and rank correlation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null, p_value_text
from ..sources.staging import stage
from .lookup import attach_by_value
from .moments import pearson
from .profile import correlation_of, group_statistics
from .ranks import average_ranks, distinct_estimates, running_totals, value_weights

#: a sample of at most this size, without ties, gets the exact distribution
EXACT_SAMPLE = 8


def rank_sums(
    df: DataFrame, columns: Sequence[str], target: str, bucket_rows: int | None = None
) -> DataFrame:
    """Per feature: sizes of class 0 and 1, U of class 0, the tie term, and the z statistic.

    ``z`` uses the larger U, the tie-corrected variance and the continuity correction.
    """
    known = df.where(F.col(target).isin(0, 1))
    features = {c: F.col(c) for c in columns}
    weights = {"n0": (F.col(target) == 0).cast("long"), "n1": (F.col(target) == 1).cast("long")}
    distinct = distinct_estimates(known, features)
    table = value_weights(known, features, weights).withColumn("n", F.col("n0") + F.col("n1"))
    ranked = running_totals(table, ["n"], distinct, bucket_rows=bucket_rows)
    n = F.col("n").cast("double")
    rank = F.col("upto_n") - n + (n + 1) / 2
    sums = ranked.groupBy("feature").agg(
        F.sum("n0").alias("n0"),
        F.sum("n1").alias("n1"),
        F.sum(F.col("n0") * rank).alias("rank_sum"),
        F.sum(n * n * n - n).alias("tie_term"),
    )
    a, b = F.col("n0").cast("double"), F.col("n1").cast("double")
    u0 = F.col("rank_sum") - a * (a + 1) / 2
    total = a + b
    variance = a * b / 12 * ((total + 1) - F.try_divide(F.col("tie_term"), total * (total - 1)))
    larger = F.greatest(F.col("u0"), a * b - F.col("u0"))
    return (
        sums.withColumn("u0", u0)
        .withColumn("z", F.try_divide(larger - a * b / 2 - 0.5, F.sqrt(variance)))
        .select("feature", "n0", "n1", "u0", "tie_term", "z")
    )


@lru_cache
def _numerator(parts: int) -> tuple[int, list[int]]:
    """A period L, and the coefficients of the product of (1 - q^L) / (1 - q^i) over i = 1, 1, 2 ... parts."""
    period = math.lcm(*range(1, parts + 1))
    poly = [1]
    for i in (1, *range(1, parts + 1)):
        grown = [0] * (len(poly) + period - i)
        for k in range(len(grown)):
            new = poly[k] if k < len(poly) else 0
            left = poly[k - period] if 0 <= k - period < len(poly) else 0
            grown[k] = (grown[k - i] if k >= i else 0) + new - left
        poly = grown
    return period, poly


def _partitions(upto: int, parts: int) -> int:
    """Partitions of all numbers up to ``upto`` into numbers of at most ``parts``; the cost does not grow with it."""
    period, poly = _numerator(parts)
    return sum(poly[j] * math.comb((upto - j) // period + parts, parts) for j in range(upto % period, min(len(poly), upto + 1), period))


def exact_p_value(u: float, n0: int, n1: int) -> float:
    """Two-sided p of U without ties, for one sample of at most ``EXACT_SAMPLE`` and another of any size.

    Outcomes with a U up to a bound are partitions in a box: partitions without the box's width, less and plus
    those that leave it, one term for each set of factors of the Gaussian binomial coefficient.
    """
    small, large = sorted((n0, n1))
    if small > EXACT_SAMPLE:
        raise ValueError(f"the exact distribution needs a sample of at most {EXACT_SAMPLE}")
    beyond = n0 * n1 - round(max(u, n0 * n1 - u))
    ways = 0
    for size in range(small + 1):
        for chosen in combinations(range(large + 1, large + small + 1), size):
            left = beyond - sum(chosen)
            if left >= 0:
                ways += (-1) ** size * _partitions(left, small)
    return min(1.0, 2 * ways / math.comb(n0 + n1, small))


METHODS = ("auto", "exact", "asymptotic")


def two_sided_p(row: Mapping, method: str = "auto") -> tuple[float | None, str | None]:
    """p of one ``rank_sums`` row and how it was found.

    ``auto`` is exact when one sample is at most ``EXACT_SAMPLE`` and nothing is tied, else the normal curve.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    n0, n1 = row["n0"], row["n1"]
    if not n0 or not n1:
        return None, None
    if method == "exact" or (method == "auto" and min(n0, n1) <= EXACT_SAMPLE and not row["tie_term"]):
        return exact_p_value(row["u0"], n0, n1), "exact"
    return 1.0 if row["z"] is None else min(1.0, math.erfc(row["z"] / math.sqrt(2))), "asymptotic"


def rank_tests(
    df: DataFrame, columns: Sequence[str], target: str, bucket_rows: int | None = None, method: str = "auto"
) -> DataFrame:
    """``rank_sums`` with p, the 5 % decision and the method used; one row per feature passes through the driver."""
    sums = rank_sums(df, columns, target, bucket_rows)
    rows = []
    for r in sums.collect():
        p, used = two_sided_p(r, method)
        rows.append((r["feature"], r["n0"], r["n1"], r["u0"], r["z"], p, None if p is None else p < 0.05, used))
    return df.sparkSession.createDataFrame(
        rows, "feature string, n0 long, n1 long, u0 double, z double, p_value double, significant boolean, method string"
    )


def group_comparison(df: DataFrame, columns: Sequence[str], target: str, **options) -> DataFrame:
    """Per feature: mean, median and spread of both classes, U of class 0, p and its decision."""
    stats = group_statistics(df, columns, target, (0, 1), **options)
    tests = rank_tests(df, columns, target).select(
        "feature",
        F.round("u0", 1).alias("u0"),
        p_value_text(F.col("p_value")).alias("p_value"),
        "significant",
    )
    return stats.join(F.broadcast(tests), "feature", "left")


def attach_ranks(
    df: DataFrame, columns: Mapping[str, Column], prefix: str = "rank_", bucket_rows: int | None = None
) -> DataFrame:
    """Adds the average rank of every expression among its present values."""
    carried = df.withColumns({f"_v{i}": nan_to_null(e) for i, e in enumerate(columns.values())})
    ranks, distinct = average_ranks(
        carried, {name: F.col(f"_v{i}") for i, name in enumerate(columns)}, bucket_rows
    )
    # one lookup per column reads its own folder instead of ranking all columns again
    ranks = stage(ranks, "ranks", "feature")
    total = carried.count()
    for i, name in enumerate(columns):
        carried = attach_by_value(
            carried, f"_v{i}", ranks.where(F.col("feature") == name), "avg_rank", f"{prefix}{name}",
            distinct[name], total,
        )
    return carried.drop(*[f"_v{i}" for i in range(len(columns))])


def rank_correlation(
    df: DataFrame, columns: Sequence[str], digits: int = 6, bucket_rows: int | None = None
) -> DataFrame:
    """Spearman r of every ordered pair: Pearson r of the average ranks over rows with both present.

    Columns without NULLs share one ranking, and their pairs come from one scan. A column is ranked again for every
    partner with NULLs.
    """
    frame = df.select(*[nan_to_null(F.col(c)).alias(c) for c in columns])
    row = frame.agg(*[F.max(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    holes = {c: bool(row[f"m{i}"]) for i, c in enumerate(columns)}
    needed: dict[str, Column] = {}

    def ranked(column: str, partner: str) -> str:
        name = f"{column}|{partner}" if holes[partner] and partner != column else column
        needed[name] = F.when(F.col(partner).isNotNull(), F.col(column)) if "|" in name else F.col(column)
        return name

    names = {(a, b): (ranked(a, b), ranked(b, a)) for a in columns for b in columns}
    numbered = {name: f"r{i}" for i, name in enumerate(needed)}
    with_ranks = attach_ranks(frame, {numbered[n]: e for n, e in needed.items()}, "_", bucket_rows)
    with_ranks = stage(with_ranks.select(*[f"_{r}" for r in numbered.values()]), "ranked")
    if len(numbered) == len(columns):
        plain = with_ranks.select(*[F.col(f"_{numbered[c]}").alias(c) for c in columns])
        return pearson(plain, columns, digits)
    pairs = {
        key: (F.col(f"_{numbered[left]}"), F.col(f"_{numbered[right]}")) for key, (left, right) in names.items()
    }
    return correlation_of(with_ranks, pairs, columns, digits)
