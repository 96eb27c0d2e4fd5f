"""Scaling numeric columns. ``fit_scaler`` returns centre and width per column for later reuse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null
from .quantiles import column_quantiles

KINDS = ("standard", "robust", "minmax")


@dataclass(frozen=True)
class Scaler:
    """``(x - centre) / width`` per column; a width of zero is replaced by one at fitting."""

    kind: str
    centre: dict[str, float]
    width: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(self.centre[c])) / F.lit(self.width[c])
                for c in self.centre
                if c in df.columns
            }
        )


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str = "robust", mode: str = "exact") -> Scaler:
    if kind not in KINDS:
        raise ValueError(f"unknown scaler: {kind}")
    if kind == "robust":
        fits = column_quantiles(df, columns, [0.25, 0.5, 0.75], mode)
        centre = {c: f.values[1] for c, f in fits.items() if f.count}
        width = {c: f.values[2] - f.values[0] for c, f in fits.items() if f.count}
    else:
        low = F.avg if kind == "standard" else F.min
        row = df.agg(
            *[low(nan_to_null(F.col(c))).alias(f"c{i}") for i, c in enumerate(columns)],
            *[
                (
                    F.stddev_pop(nan_to_null(F.col(c)))
                    if kind == "standard"
                    else F.max(nan_to_null(F.col(c))) - F.min(nan_to_null(F.col(c)))
                ).alias(f"w{i}")
                for i, c in enumerate(columns)
            ],
        ).first()
        centre = {c: row[f"c{i}"] for i, c in enumerate(columns) if row[f"c{i}"] is not None}
        width = {c: row[f"w{i}"] for i, c in enumerate(columns) if row[f"c{i}"] is not None}
    return Scaler(kind, {c: float(v) for c, v in centre.items()}, {c: float(w) or 1.0 for c, w in width.items()})


def scale(df: DataFrame, columns: Sequence[str], kind: str = "robust", mode: str = "exact"):
    """The scaled table and the scaler that produced it."""
    scaler = fit_scaler(df, columns, kind, mode)
    return scaler.apply(df), scaler
