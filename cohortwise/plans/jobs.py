"""The jobs a user runs: clean a raw table, report on a cohort, score records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..learners.artifact import Scorer
from ..operators import clean, cohort, profile, rank_tests
from ..operators.features import Derivations, derive
from ..sources.gate import require_complete, require_schema
from ..sources.sinks import write_table
from ..sources.staging import stage


@dataclass(frozen=True)
class Cleaning:
    cleaned: DataFrame
    engineered: DataFrame
    reports: dict[str, DataFrame]


def run_cleaning(
    raw: DataFrame,
    contract: Contract,
    derivations: Derivations,
    imputation: str = "median_by_group",
    outliers: str = "winsorize",
    outlier_columns: Sequence[str] | None = None,
    out: str | None = None,
    fmt: str = "csv",
) -> Cleaning:
    """Gate, profile, fill, limit, check and derive; the two tables are written below ``out``.

    Profile and outlier report describe the readings before anything is filled.
    """
    require_schema(raw, contract)
    key, label = contract.key, contract.target.name
    # read by every fit that follows, so it is written once
    readings = stage(clean.zeros_to_missing(raw, contract.disguised), "readings")
    numeric = [c for c in contract.numeric if c in readings.columns]
    reports = {
        "missingness": profile.missingness(raw, contract.disguised, [c for c in (key, label) if c]),
        "summary": profile.summary_statistics(readings, numeric),
        "comparison": rank_tests.group_comparison(readings, numeric, label),
        "outliers": profile.outlier_fences(readings, numeric),
    }
    filled = clean.impute(readings, imputation, by=label, key=key)
    limited = [c for c in outlier_columns or numeric[1:] if c in filled.columns]
    cleaned = clean.limit_outliers(filled, limited, outliers)
    require_complete(cleaned)
    engineered = derive(cleaned, derivations)
    if out:
        write_table(cleaned, f"{out}/cleaned", fmt)
        write_table(engineered, f"{out}/engineered", fmt)
        for name, table in reports.items():
            write_table(table, f"{out}/reports/{name}", fmt)
    return Cleaning(cleaned, engineered, reports)


def cohort_report(
    df: DataFrame,
    contract: Contract,
    score: str | None = None,
    bands: Sequence[str] = (),
    roles: dict[str, str] | None = None,
    out: str | None = None,
) -> dict[str, DataFrame]:
    """Every cohort table of one population. ``roles`` names the primary, body and age columns."""
    key, label = contract.key, contract.target.name
    numeric = [c for c in contract.numeric if c in df.columns]
    roles = {"primary": numeric[0], "body": numeric[0], "age": numeric[0], **(roles or {})}
    ranking = [c for c in (score, roles["primary"]) if c]
    tables = {
        "headline": cohort.headline(df, label, score),
        "class_balance": profile.class_balance(df, label, cohort.POSITIVE_LABEL, cohort.NEGATIVE_LABEL),
        "top_records": cohort.top_records(df, key, ranking, label),
        "prevalence_line": cohort.prevalence_line(df, roles["age"], label),
        "rate_by_band": cohort.rate_by_band(df, roles["body"], label),
        "distribution": cohort.cumulative_distribution(df, roles["primary"]),
        "histogram": cohort.histogram(df, numeric),
        "scatter": cohort.scatter_sample(df, key, [roles["primary"], roles["body"]], label),
        "completeness": cohort.completeness(df),
        "boxes": profile.box_statistics(df, numeric),
        "correlation": profile.correlation(df, [*numeric, label], 2),
        "implausible_zeros": cohort.implausible_zeros(df, contract),
        "label_spikes": cohort.label_spikes(df, numeric, label),
        "duplicates": cohort.duplicate_report(df.drop(key) if key else df, contract),
        "majority_floor": cohort.majority_floor(df, label),
    }
    if score:
        tables["score_levels"] = cohort.ordinal_counts(df, score)
        tables["rate_by_score"] = cohort.rate_by_level(df, score, label)
    for name in bands:
        tables[f"share_{name}"] = cohort.folded_categories(df, name)
        tables[f"rate_{name}"] = cohort.rate_by_category(df, name, label)
    if out:
        for name, table in tables.items():
            write_table(table, f"{out}/{name}")
    return tables


def score_records(
    records: DataFrame, scorer: Scorer, cohort_table: DataFrame, contract: Contract, primary: str
) -> tuple[DataFrame, DataFrame]:
    """Scored records with the cohort percentile of the primary reading, and the comparison table."""
    scored = scorer.score(records)
    placed = cohort.percentile_lookup(scored, cohort_table, primary, "primary_percentile")
    return placed, cohort.record_comparison(records, cohort_table, contract.key, contract)


def score_summary(scored: DataFrame) -> DataFrame:
    """How many records each source scored and how many it flagged."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("label").alias("flagged"),
        F.round(F.avg("probability"), 6).alias("mean_probability"),
    )
