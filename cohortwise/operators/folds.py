"""Stratified splits and folds by a hash of the key, with exact sizes per class."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import HASH_RANGE, hash52
from .quantiles import fit_quantiles

# Seed, held-out share and number of folds of a training run.
SEED = 42
TEST_SHARE = 0.2
FOLDS = 10


def class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    rows = df.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    return {r[label]: r["count"] for r in sorted(rows, key=lambda r: r[label])}


def _shared_out(sizes: dict[int, int], wanted: int) -> dict[int, int]:
    """``wanted`` rows over the classes in proportion, remainders to the largest fractions."""
    total = sum(sizes.values())
    exact = {c: wanted * n / total for c, n in sizes.items()}
    out = {c: math.floor(v) for c, v in exact.items()}
    for c in sorted(sizes, key=lambda c: (out[c] - exact[c], c))[: wanted - sum(out.values())]:
        out[c] += 1
    return out


def _hash_cuts(
    df: DataFrame, key: str, label: str, seed: int, ranks: dict[int, list[int]], sizes: dict[int, int], limits: dict
) -> dict[int, list[float]]:
    """Per class, values with exactly the wanted numbers of hashes below them."""
    hashed = F.col("_hash")
    specs = {}
    for c, wanted in ranks.items():
        inner = [r for r in wanted if 0 < r < sizes[c]]
        probs = [(r - 0.5) / (sizes[c] - 1) for r in inner]
        specs[str(c)] = (F.when(F.col(label) == c, hashed), probs or [0.5])
    # a kept column: the passes of the fit compare it many times, and would take the hash anew for each comparison
    narrow = df.select(label, hash52(F.col(key), seed).alias("_hash")).persist()
    try:
        fits = fit_quantiles(narrow, specs, **limits)
    finally:
        narrow.unpersist()
    cuts = {}
    for c, wanted in ranks.items():
        inner = iter(fits[str(c)].values)
        cuts[c] = [0.0 if r <= 0 else HASH_RANGE if r >= sizes[c] else next(inner) for r in wanted]
    return cuts


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    exact: bool = True,
    **limits,
) -> DataFrame:
    """Adds ``part``: ``test`` for the wanted share of every class, ``train`` for the rest.

    Exact sizes cost one count and one order-statistic fit; otherwise the hash is cut at the share.
    """
    hashed = hash52(F.col(key), seed)
    if not exact:
        chosen = hashed < F.lit(test_share * HASH_RANGE)
    else:
        sizes = class_sizes(df, label)
        wanted = _shared_out(sizes, math.ceil(test_share * sum(sizes.values())))
        cuts = _hash_cuts(df, key, label, seed, {c: [k] for c, k in wanted.items()}, sizes, limits)
        chosen = F.lit(False)
        for c, (cut,) in cuts.items():
            chosen = F.when(F.col(label) == c, hashed < F.lit(cut)).otherwise(chosen)
    return df.withColumn("part", F.when(chosen, "test").otherwise("train"))


def fold_number(key: str, folds: int, seed: int) -> Column:
    """A fold from the hash alone; sizes are equal up to chance."""
    return F.pmod(hash52(F.col(key), seed), F.lit(folds)).cast("int")


def stratified_folds(
    df: DataFrame,
    key: str,
    label: str,
    folds: int = FOLDS,
    seed: int = SEED,
    exact: bool = True,
    **limits,
) -> DataFrame:
    """Adds ``fold`` 0..folds-1; every class is spread evenly, to within one row."""
    if not exact:
        return df.withColumn("fold", fold_number(key, folds, seed))
    sizes = class_sizes(df, label)
    ranks = {c: [i * n // folds for i in range(1, folds)] for c, n in sizes.items()}
    cuts = _hash_cuts(df, key, label, seed, ranks, sizes, limits)
    hashed = F.col("_hash")
    fold = F.lit(None).cast("int")
    for c, edges in cuts.items():
        number = F.lit(folds - 1)
        for i in range(folds - 2, -1, -1):
            number = F.when(hashed < F.lit(edges[i]), F.lit(i)).otherwise(number)
        fold = F.when(F.col(label) == c, number).otherwise(fold)
    return df.withColumn("_hash", hash52(F.col(key), seed)).withColumn("fold", fold).drop("_hash")


def class_weights(df: DataFrame, label: str) -> dict[int, float]:
    """Balanced weights: rows over twice the rows of the class."""
    return balanced(class_sizes(df, label))


def balanced(sizes: dict[int, int]) -> dict[int, float]:
    total = sum(sizes.values())
    return {c: total / (len(sizes) * n) for c, n in sizes.items()}


def positive_weight(df: DataFrame, label: str) -> float:
    """Negatives per positive."""
    sizes = class_sizes(df, label)
    return sizes.get(0, 0) / max(sizes.get(1, 0), 1)


def weight_column(label: str, weights: dict[int, float]) -> Column:
    out = F.lit(1.0)
    for c, w in weights.items():
        out = F.when(F.col(label) == c, F.lit(float(w))).otherwise(out)
    return out
