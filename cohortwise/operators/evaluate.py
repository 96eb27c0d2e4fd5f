"""Evaluation of probability scores against a 0/1 label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import fit_quantiles
from .ranks import distinct_estimates, running_totals, value_weights

# Probabilities of the threshold grid, its rounding and the recall floor.
GRID_PROBS = [float(p) for p in np.linspace(0.02, 0.98, 97)]
GRID_DIGITS = 4
RECALL_FLOOR = 0.70


def ranking_scores(
    df: DataFrame, label: str, scores: Mapping[str, Column] | Sequence[str], bucket_rows: int | None = None
) -> DataFrame:
    """Average precision (a step sum, no interpolation) and ROC-AUC (ties count half) per score.

    Rows are summed per distinct score first. All scores are handled in the same pass. Rows without a label
    take no part.
    """
    df = df.where(F.col(label).isNotNull())
    if not isinstance(scores, Mapping):
        scores = {name: F.col(name) for name in scores}
    distinct = distinct_estimates(df, scores)
    table = value_weights(df, scores, {"tp": F.col(label).cast("long"), "n": F.lit(1)})
    table = table.withColumn("neg", F.col("n") - F.col("tp"))
    run = running_totals(table, ["tp", "neg"], distinct, descending=True, bucket_rows=bucket_rows)
    tp, neg = F.col("tp").cast("double"), F.col("neg").cast("double")
    sums = run.groupBy("feature").agg(
        F.sum(tp).alias("P"),
        F.sum(neg).alias("N"),
        F.sum(tp * F.col("upto_tp") / (F.col("upto_tp") + F.col("upto_neg"))).alias("precision_sum"),
        F.sum(tp * (F.col("upto_neg") - neg / 2)).alias("outranked"),
    )
    return sums.select(
        F.col("feature").alias("score"),
        F.try_divide("precision_sum", "P").alias("pr_auc"),
        (1 - F.try_divide(F.col("outranked"), F.col("P") * F.col("N"))).alias("roc_auc"),
    )


def average_precision(df: DataFrame, label: str, score: str, bucket_rows: int | None = None) -> DataFrame:
    return ranking_scores(df, label, [score], bucket_rows).select("pr_auc")


def roc_auc(df: DataFrame, label: str, score: str, bucket_rows: int | None = None) -> DataFrame:
    return ranking_scores(df, label, [score], bucket_rows).select("roc_auc")


def _cells(label: str, predicted: Column) -> list[Column]:
    y = F.col(label)
    tests = {
        "tn": (y == 0) & (predicted == 0),
        "fp": (y == 0) & (predicted == 1),
        "fn": (y == 1) & (predicted == 0),
        "tp": (y == 1) & (predicted == 1),
    }
    return [F.count_if(test).alias(name) for name, test in tests.items()]


def confusion(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row with all four cells, also when a class does not occur."""
    return df.agg(*_cells(label, (F.col(score) >= F.lit(float(threshold))).cast("int")))


def confusion_table(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """The same four cells as one row per true class."""
    cells = confusion(df, label, score, threshold)
    return cells.selectExpr(
        "stack(2, 0, tn, fp, 1, fn, tp) AS (actual, predicted_negative, predicted_positive)"
    )


def _safe(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def rates(cells: DataFrame) -> DataFrame:
    """Recall, precision, F1 (each 0 where undefined) and accuracy from ``tn, fp, fn, tp``."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.withColumns(
        {
            "recall": _safe(tp, tp + fn),
            "precision": _safe(tp, tp + fp),
            "f1": _safe(2 * tp, 2 * tp + fp + fn),
            "accuracy": _safe(tp + tn, tp + tn + fp + fn),
        }
    )


def scores_at(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Confusion cells and rates at one threshold."""
    return rates(confusion(df, label, score, threshold)).withColumn("threshold", F.lit(float(threshold)))


def threshold_table(
    df: DataFrame,
    label: str,
    score: str,
    probs: Sequence[float] = GRID_PROBS,
    digits: int = GRID_DIGITS,
    mode: str = "exact",
    **limits,
) -> DataFrame:
    """Recall, precision and F1 at every candidate threshold.

    Candidates are rounded quantiles of the score. Each row is counted in the bucket between two
    candidates, so one scan serves them all; the suffix sums run over the bucket counts.
    """
    fit = fit_quantiles(df, {score: (F.col(score), probs)}, mode, **limits)[score]
    grid = sorted({float(v) for v in np.round([v for v in fit.values if v is not None], digits)})
    counts = (
        Bucketizer(
            inputCol="_score",
            outputCol="_bucket",
            splits=[float("-inf"), *grid, float("inf")],
            handleInvalid="skip",
        )
        .transform(df.select(F.col(score).cast("double").alias("_score"), F.col(label).alias("_label")))
        .groupBy("_bucket")
        .agg(F.count_if(F.col("_label") == 1).alias("pos"), F.count_if(F.col("_label") == 0).alias("neg"))
        .collect()
    )
    by_bucket = {int(r["_bucket"]): (r["pos"], r["neg"]) for r in counts}
    pos_all = sum(p for p, _ in by_bucket.values())
    rows, tp, fp = [], 0, 0
    for number in range(len(grid), 0, -1):
        p, n = by_bucket.get(number, (0, 0))
        tp, fp = tp + p, fp + n
        recall = tp / pos_all if pos_all else 0.0
        precision = tp / (tp + fp) if tp + fp else 0.0
        f1 = 2 * tp / (tp + fp + pos_all) if tp + fp + pos_all else 0.0
        rows.append((grid[number - 1], tp, fp, recall, precision, f1))
    return df.sparkSession.createDataFrame(
        rows[::-1], "threshold double, tp long, fp long, recall double, precision double, f1 double"
    )


def best_threshold(
    df: DataFrame, label: str, score: str, floor: float = RECALL_FLOOR, mode: str = "exact", **limits
) -> DataFrame:
    """The candidate with the highest F1 among those that reach the recall floor, else among all.

    Of equal ones the lowest threshold wins.
    """
    table = threshold_table(df, label, score, mode=mode, **limits)
    allowed = F.col("recall") >= F.lit(floor)
    return table.orderBy(F.desc(allowed.cast("int")), F.desc("f1"), "threshold").limit(1)
