"""Cleaning: disguised zeros, imputation and outlier limits, with fitting kept apart from applying.

A ``fit_*`` function runs aggregates and returns a small plain object; ``apply`` only adds literal
expressions, so a cleaned table is one projection over the scan and no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, is_missing, nan_to_null, zero_to_null
from .quantiles import column_quantiles, group_quantiles, group_values

IMPUTATIONS = ("median_by_group", "median", "mean", "knn")
OUTLIER_METHODS = ("winsorize", "iqr_cap", "none")


def zeros_to_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zeros of the listed columns that exist become NULL."""
    return df.withColumns({c: zero_to_null(F.col(c)) for c in columns if c in df.columns})


def columns_with_missing(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    columns = list(columns or df.columns)
    row = df.agg(*[F.max(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"m{i}"]]


@dataclass(frozen=True)
class Filler:
    """Fill values per column: one per group where ``by`` is set, then one for what is left."""

    overall: dict[str, float | None]
    by: str | None = None
    grouped: dict[tuple, float | None] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        out = {}
        for name in self.overall:
            value = nan_to_null(F.col(name))
            choices = [value]
            groups = [g for g, c in self.grouped if c == name and self.grouped[g, c] is not None]
            if groups:
                expr = None
                for g in groups:
                    test, fill = F.col(self.by) == F.lit(g), F.lit(float(self.grouped[g, name]))
                    expr = F.when(test, fill) if expr is None else expr.when(test, fill)
                choices.append(expr)
            if self.overall[name] is not None:
                choices.append(F.lit(float(self.overall[name])))
            out[name] = F.coalesce(*choices)
        return df.withColumns(out)


def fit_median(df: DataFrame, columns: Sequence[str], mode: str = "exact", **limits) -> Filler:
    fits = column_quantiles(df, columns, [0.5], mode, **limits)
    return Filler({c: fits[c].values[0] for c in columns})


def fit_mean(df: DataFrame, columns: Sequence[str]) -> Filler:
    row = df.agg(*[F.avg(nan_to_null(F.col(c))).alias(f"a{i}") for i, c in enumerate(columns)]).first()
    return Filler({c: row[f"a{i}"] for i, c in enumerate(columns)})


def fit_group_median(
    df: DataFrame,
    columns: Sequence[str],
    by: str,
    groups: Sequence | None = None,
    mode: str = "exact",
    **limits,
) -> Filler:
    """Median per group of ``by``; what a group cannot fill gets the median of the partly filled column.

    The fill values carry the grouping column. Use this for reports, never before model training.
    """
    columns = [c for c in columns if c != by]
    groups = list(groups) if groups is not None else group_values(df, by)
    fits = group_quantiles(df, columns, [0.5], by, groups, mode, **limits)
    grouped = {key: fit.values[0] for key, fit in fits.items()}
    first = Filler({c: None for c in columns}, by, grouped)
    filled = first.apply(df)
    left = filled.agg(*[F.max(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    open_columns = [c for i, c in enumerate(columns) if left[f"m{i}"]]
    overall: dict[str, float | None] = {c: None for c in columns}
    if open_columns:
        rest = column_quantiles(filled, open_columns, [0.5], mode, **limits)
        overall.update({c: rest[c].values[0] for c in open_columns})
    return Filler(overall, by, grouped)


def impute(
    df: DataFrame,
    strategy: str = "median_by_group",
    columns: Sequence[str] | None = None,
    by: str | None = None,
    key: str | None = None,
    neighbours: int = 5,
    mode: str = "exact",
) -> DataFrame:
    """Fill missing cells. Without ``columns``, every column that has one is filled."""
    if strategy not in IMPUTATIONS:
        raise ValueError(f"unknown imputation strategy: {strategy}")
    if strategy == "knn":
        from .knn import impute_nearest

        numeric = [
            f.name for f in df.schema.fields if f.dataType.typeName() in _NUMERIC and f.name not in (by, key)
        ]
        return impute_nearest(df, numeric, neighbours)
    if columns is None:
        columns = columns_with_missing(df, [c for c in df.columns if c not in (by, key)])
    if not columns:
        return df
    if strategy == "median_by_group":
        if by is None or by not in df.columns:
            raise ValueError("median_by_group needs a grouping column that exists")
        return fit_group_median(df, columns, by, mode=mode).apply(df)
    if strategy == "median":
        return fit_median(df, columns, mode).apply(df)
    return fit_mean(df, columns).apply(df)


_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


@dataclass(frozen=True)
class Limits:
    """Lower and upper limit per column; a column without values has none and stays as it is."""

    bounds: dict[str, tuple[float, float]]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in self.bounds.items() if c in df.columns}
        )


def fit_limits(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "winsorize",
    lower: float = 0.01,
    upper: float = 0.99,
    multiplier: float = 1.5,
    mode: str = "exact",
    **limits,
) -> Limits:
    """Quantile limits (winsorize) or quartile fences with the lower one not below zero (iqr_cap)."""
    if method not in OUTLIER_METHODS:
        raise ValueError(f"unknown outlier method: {method}")
    if method == "none":
        return Limits({})
    present = [c for c in columns if c in df.columns]
    probs = [lower, upper] if method == "winsorize" else [0.25, 0.75]
    bounds = {}
    for name, fit in column_quantiles(df, present, probs, mode, **limits).items():
        if not fit.count:
            continue
        low, high = fit.values
        if method == "iqr_cap":
            reach = multiplier * (high - low)
            low, high = max(0.0, low - reach), high + reach
        bounds[name] = (low, high)
    return Limits(bounds)


def limit_outliers(df: DataFrame, columns: Sequence[str], method: str = "winsorize", **options) -> DataFrame:
    return fit_limits(df, columns, method, **options).apply(df)
