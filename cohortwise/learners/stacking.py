"""Out-of-fold prediction, stacking and the leaderboard."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import ranking_scores
from ..operators.folds import class_weights, stratified_folds, weight_column
from ..sources.staging import stage
from .pipelines import WEIGHT, Learner, Settings, Shared, _drop, candidates, probability


def keyed(df: DataFrame, key: str) -> DataFrame:
    """Rows with the key under the name the learners read for their inner folds."""
    return df.withColumn("_row", F.col(key))


def folded_table(df: DataFrame, key: str, label: str, folds: int, seed: int) -> DataFrame:
    """The table written once per fold folder, so a fold's scan never opens the other folders."""
    return stage(stratified_folds(df, key, label, folds, seed), "folds", "fold")


#: Fits that run beside each other. A fit of a small fold is a chain of short jobs that leaves executors idle.
FITS_AT_ONCE = 4


def side_by_side(spark: SparkSession, tasks: Sequence[Callable], at_once: int) -> list:
    """The results of independent calls, in order, from a bounded pool of threads with the caller's job properties."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(lambda task: task(), [inherit(task) for task in tasks]))


def out_of_fold(
    folded: DataFrame, learners: Sequence[Learner], folds: int, keep: Sequence[str], at_once: int | None = None
) -> DataFrame:
    """Every row predicted by models that were fitted without its fold.

    Folds and learners are fitted side by side. All learners of a fold run over the same held-out rows in one
    chain, so nothing has to be joined. They share what they fit to the same rows.
    """
    trains = [(folded.where(F.col("fold") != i), Shared()) for i in range(folds)]
    tasks = [lambda learner=learner, train=train: learner.fit(*train) for train in trains for learner in learners]
    fitted = iter(side_by_side(folded.sparkSession, tasks, FITS_AT_ONCE if at_once is None else at_once))
    parts = None
    for i in range(folds):
        held = folded.where(F.col("fold") == i)
        for learner in learners:  # outputs are set aside: a stack makes columns of its members' names on the way
            held = next(fitted).transform(held).withColumnRenamed(learner.output, f"held_{learner.output}")
        held = held.select(*keep, *[F.col(f"held_{learner.output}").alias(learner.output) for learner in learners])
        parts = held if parts is None else parts.unionByName(held)
    return parts


def stacking(
    features: Sequence[str], label: str, settings: Settings = Settings(), name: str = "stacking"
) -> Learner:
    """A weighted logistic regression over the level-0 columns ``p_*``, which are predicted out of fold."""
    level0 = list(candidates(features, label, settings).values())

    def fit(train: DataFrame, shared: Shared | None = None) -> PipelineModel:
        shared = shared or Shared()
        base = train.drop("fold")
        folded = folded_table(base, "_row", label, settings.stacking_folds, settings.seed + 2)
        # written out, so the meta model does not run the fold models again in every iteration
        inner = stage(out_of_fold(folded, level0, settings.stacking_folds, [label]), "stacking")
        assembler = VectorAssembler(inputCols=[m.output for m in level0], outputCol="m_v")
        weighted = assembler.transform(inner).withColumn(
            WEIGHT, weight_column(label, class_weights(inner, label))
        )
        total = float(weighted.agg(F.sum(WEIGHT)).first()[0])
        meta = LogisticRegression(
            featuresCol="m_v", labelCol=label, weightCol=WEIGHT, predictionCol="m_c", probabilityCol="m_p",
            rawPredictionCol="m_r", maxIter=settings.iterations, regParam=1.0 / total, standardization=False,
        ).fit(weighted)
        final = side_by_side(base.sparkSession, [lambda learner=learner: learner.fit(base, shared) for learner in level0], FITS_AT_ONCE)
        return PipelineModel(
            [
                *final,
                assembler,
                meta,
                VectorSlicer(inputCol="m_p", outputCol=f"p_{name}", indices=[1]),
                _drop("m_v", "m_p", "m_r", "m_c", *[m.output for m in level0]),
            ]
        )

    return Learner(name, fit)


def scores_table(predictions: DataFrame, learners: Sequence[Learner], keep: Sequence[str]) -> DataFrame:
    """One plain probability column per learner."""
    return predictions.select(*keep, *[probability(m.output).alias(m.name) for m in learners])


def leaderboard(predictions: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    """Cross-validated average precision and ROC-AUC per learner."""
    return ranking_scores(predictions, label, list(names)).select(
        F.col("score").alias("model"), F.col("pr_auc").alias("cv_pr_auc"), F.col("roc_auc").alias("cv_roc_auc")
    )
