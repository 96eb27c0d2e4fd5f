"""Checks a table has to pass before it is used. Each costs one aggregate over the table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.scalar import is_missing
from ..operators.shape import rows_of


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    have = set(df.columns)
    return [c for c in contract.required if c not in have]


def gate_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: number of rows and number of rows whose target is neither 0 nor 1."""
    target = F.col(contract.target.name)
    bad = target.isNull() | ~target.isin(0, 1)
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(bad).alias("bad_targets"))


def require_schema(df: DataFrame, contract: Contract) -> bool:
    """Every required column, at least one row, a 0/1 target; a surprising row count only warns."""
    absent = missing_columns(df, contract)
    if absent:
        raise ValueError(f"the table lacks expected columns: {sorted(absent)}")
    row = gate_report(df, contract).first()
    if row["row_count"] == 0:
        raise ValueError("the table is empty")
    if row["bad_targets"]:
        raise ValueError(f"target {contract.target.name} must hold only 0 and 1")
    if contract.rows_expected is not None and row["row_count"] != contract.rows_expected:
        warnings.warn(f"expected {contract.rows_expected} rows, found {row['row_count']}", stacklevel=2)
    return True


def conformance(df: DataFrame, contract: Contract) -> DataFrame:
    """Per field: readings below and above the declared range, outside the domain, and missing."""
    aggs, rows = [], []
    for i, item in enumerate(f for f in (*contract.features, contract.target) if f.name in df.columns):
        c = F.when(~is_missing(df, item.name), F.col(item.name))
        below = c < F.lit(item.low) if item.low is not None else F.lit(False)
        above = c > F.lit(item.high) if item.high is not None else F.lit(False)
        domain = item.values or ((0, 1) if item.kind == "binary" else ())
        outside = ~c.isin(*domain) if domain else F.lit(False)
        names = ("below_min", "above_max", "outside_domain", "missing")
        for name, test in zip(names, (below, above, outside, c.isNull())):
            aggs.append(F.count_if(test).alias(f"{name}_{i}"))
        rows.append({"field": F.lit(item.name), **{n: F.col(f"{n}_{i}") for n in names}})
    return rows_of(df.agg(*aggs), rows)


def require_complete(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    """Stop when any cell is missing."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    left = {c: row[f"m{i}"] for i, c in enumerate(columns) if row[f"m{i}"]}
    if left:
        raise ValueError(f"missing cells remain: {left}")
