"""Candidate learners. Filling and scaling are fitted inside ``fit``, on the rows it is given only.

A fitted learner is one ``PipelineModel`` of built-in stages: a SQL projection holding the fitted
medians (and scaling), an assembler, the classifier, and a slice of the positive probability. It can
be saved, loaded and applied to a stream as it is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Hashable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass, field
from threading import Lock

import numpy as np
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null
from ..operators.clean import fit_median
from ..operators.folds import SEED, balanced, class_sizes, stratified_folds, weight_column
from ..operators.scale import fit_scaler

WEIGHT = "_weight"


@dataclass(frozen=True)
class Settings:
    """Sizes of the learners. The defaults are the fixed values of a full training run."""

    iterations: int = 2000
    trees: int = 400
    min_leaf: int = 2
    forest_depth: int = 30
    rounds: int = 400
    step: float = 0.05
    boost_depth: int = 3
    row_share: float = 0.9
    column_share: float = 0.9
    svm_cost: float = 2.0
    svm_iterations: int = 100
    kernel_terms: int = 0
    calibration_folds: int = 3
    stacking_folds: int = 5
    seed: int = SEED
    mode: str = "exact"
    learners: tuple[str, ...] = ("logistic_regression", "random_forest", "gradient_boosting", "svm")


class Shared:
    """What fits over the same rows have in common, each made once: medians, scaling, class sizes and whole models.

    Fits side by side wait for the one that makes it.
    """

    def __init__(self):
        self._made: dict[Hashable, Future] = {}
        self._lock = Lock()

    def once(self, name: Hashable, make: Callable):
        with self._lock:
            mine = name not in self._made
            made = self._made.setdefault(name, Future())
        if mine:
            try:
                made.set_result(make())
            except BaseException as error:
                made.set_exception(error)
        return made.result()


@dataclass(frozen=True)
class Learner:
    """A named recipe: ``fit`` returns a model that adds ``p_<name>``, a vector of one probability.

    Fits of several learners over the same rows may be given one ``Shared``.
    """

    name: str
    fit: Callable[..., PipelineModel] = field(repr=False)

    @property
    def output(self) -> str:
        return f"p_{self.name}"


def probability(column: str) -> Column:
    """The probability inside a one-element vector."""
    return vector_to_array(F.col(column))[0]


def fourier_columns(names: Sequence[str], terms: int, seed: int) -> list[str]:
    """SQL of ``terms`` random Fourier features of scaled columns.

    Their inner products approach the radial kernel exp(-g * distance**2), with an error that falls as one over the
    root of ``terms``. The width g is one over the number of columns, as each column has a variance of one.
    """
    draw = np.random.default_rng(seed)
    slopes = draw.normal(0.0, math.sqrt(2.0 / len(names)), (terms, len(names)))
    shifts = draw.uniform(0.0, 2.0 * math.pi, terms)
    height = math.sqrt(2.0 / terms)
    turns = [" + ".join(f"({float(w)!r}D) * `{n}`" for w, n in zip(row, names)) for row in slopes]
    return [f"{height!r}D * cos({turn} + {float(shift)!r}D)" for turn, shift in zip(turns, shifts)]


def preparation(
    train: DataFrame, features: Sequence[str], prefix: str, scaled: bool, mode: str, kernel: tuple[int, int] = (0, 0),
    shared: Shared | None = None,
) -> list[Transformer]:
    """Median filling and, for ``scaled``, centring and scaling, as literals in one projection.

    A column without any reading in ``train`` has no median and becomes 0. With ``kernel``, a number of terms above 0
    and a seed, the vector holds that many random Fourier features of the scaled columns instead of the columns.
    """
    shared = shared or Shared()
    fitted = shared.once(("medians", *features, mode), lambda: fit_median(train, features, mode).overall)
    medians = {c: (v or 0.0) for c, v in fitted.items()}
    filled = {c: F.coalesce(nan_to_null(F.col(c)), F.lit(medians[c])) for c in features}
    parts, scaler = [], None
    if scaled:
        whole = train.select(*[e.alias(c) for c, e in filled.items()])
        scaler = shared.once(("scaler", *features, mode), lambda: fit_scaler(whole, features, "standard"))
    for i, c in enumerate(features):
        text = f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {medians[c]!r}D)"
        if scaler:
            text = f"({text} - ({scaler.centre[c]!r}D)) / ({scaler.width[c]!r}D)"
        parts.append(f"{text} AS `{prefix}{i}`")
    names = [f"{prefix}{i}" for i in range(len(features))]
    stages, inputs = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")], names
    if kernel[0]:
        waves = fourier_columns(names, *kernel)
        inputs = [f"{prefix}w{i}" for i in range(len(waves))]
        made = ", ".join(f"{wave} AS `{name}`" for wave, name in zip(waves, inputs))
        stages.append(SQLTransformer(statement=f"SELECT *, {made} FROM __THIS__"))
        names = [*names, *inputs]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=f"{prefix}v"), _drop(*names)]


def _drop(*columns: str) -> SQLTransformer:
    return SQLTransformer(statement="SELECT * EXCEPT (" + ", ".join(f"`{c}`" for c in columns) + ") FROM __THIS__")


def _classifier(
    name: str,
    features: Sequence[str],
    label: str,
    make: Callable[[int], Estimator],
    scaled: bool,
    weighting: str | None,
    settings: Settings,
    finish: Callable | None = None,
    kernel_terms: int = 0,
) -> Learner:
    prefix = f"x_{name}_"

    def make_model(train: DataFrame, shared: Shared) -> PipelineModel:
        stages = preparation(train, features, prefix, scaled, settings.mode, (kernel_terms, settings.seed), shared)
        sizes = shared.once(("sizes", label), lambda: class_sizes(train, label))
        weights = balanced(sizes)
        if weighting == "positive" and 0 in weights and 1 in weights:
            weights = {0: 1.0, 1: weights[1] / weights[0]}
        # the estimators keep their own blocks or points; a copy of the vectors beside them would not be read again
        rows = train.select(*features, F.col(label).cast("double").alias(label), "_row")
        rows = rows.withColumn(WEIGHT, weight_column(label, weights))
        if finish:
            return PipelineModel([*stages, *finish(rows, PipelineModel(stages))])
        vectors = PipelineModel(stages).transform(rows).select(f"{prefix}v", label, WEIGHT)
        total = float(sum(n * weights.get(c, 1.0) for c, n in sizes.items()))
        estimator = make(total).setFeaturesCol(f"{prefix}v").setLabelCol(label).setWeightCol(WEIGHT)
        estimator = (
            estimator.setPredictionCol(f"{prefix}c")
            .setProbabilityCol(f"{prefix}p")
            .setRawPredictionCol(f"{prefix}r")
        )
        return PipelineModel(
            [
                *stages,
                estimator.fit(vectors),
                VectorSlicer(inputCol=f"{prefix}p", outputCol=f"p_{name}", indices=[1]),
                _drop(f"{prefix}v", f"{prefix}p", f"{prefix}r", f"{prefix}c"),
            ]
        )

    def fit(train: DataFrame, shared: Shared | None = None) -> PipelineModel:
        shared = shared or Shared()
        return shared.once((name, *features, label, settings), lambda: make_model(train, shared))

    return Learner(name, fit)


def logistic_regression(features: Sequence[str], label: str, settings: Settings = Settings()) -> Learner:
    """Balanced logistic regression with an L2 penalty of weight one against the summed loss."""
    return _classifier(
        "logistic_regression", features, label,
        lambda total: LogisticRegression(
            maxIter=settings.iterations, regParam=1.0 / total, standardization=False
        ),
        True, "balanced", settings,
    )


def random_forest(features: Sequence[str], label: str, settings: Settings = Settings()) -> Learner:
    return _classifier(
        "random_forest", features, label,
        lambda total: RandomForestClassifier(
            numTrees=settings.trees, minInstancesPerNode=settings.min_leaf, maxDepth=settings.forest_depth,
            seed=settings.seed,
        ),
        False, "balanced", settings,
    )


def gradient_boosting(features: Sequence[str], label: str, settings: Settings = Settings()) -> Learner:
    """Boosted trees in which a positive row weighs as much as the negatives per positive."""
    return _classifier(
        "gradient_boosting", features, label,
        lambda total: GBTClassifier(
            maxIter=settings.rounds, stepSize=settings.step, maxDepth=settings.boost_depth,
            subsamplingRate=settings.row_share, featureSubsetStrategy=str(settings.column_share),
            seed=settings.seed,
        ),
        False, "positive", settings,
    )


def support_vector(features: Sequence[str], label: str, settings: Settings = Settings()) -> Learner:
    """A support vector machine with a radial kernel, whose margin is turned into a probability by a sigmoid.

    The kernel is approached by random Fourier features under a linear machine, so a fit stays a chain of aggregates
    over the rows; with ``kernel_terms`` at 0 the machine is linear in the readings. The sigmoid is fitted on margins of rows the machine did not see.
    """

    prefix = "x_svm_"

    def sigmoid_of(margins: DataFrame):
        return LogisticRegression(
            featuresCol=f"{prefix}m", labelCol=label, predictionCol=f"{prefix}k", probabilityCol=f"{prefix}p",
            rawPredictionCol=f"{prefix}s", maxIter=settings.svm_iterations, standardization=False,
        ).fit(margins)

    def finish(rows: DataFrame, prepared: PipelineModel) -> list[Transformer]:
        def machine(vectors: DataFrame, total: float):
            return LinearSVC(
                featuresCol=f"{prefix}v", labelCol=label, weightCol=WEIGHT, predictionCol=f"{prefix}c",
                rawPredictionCol=f"{prefix}r", maxIter=settings.svm_iterations,
                regParam=1.0 / (settings.svm_cost * total), standardization=False,
            ).fit(vectors)

        margin = VectorSlicer(inputCol=f"{prefix}r", outputCol=f"{prefix}m", indices=[1])
        # the readings are kept as plain columns with their fold, so the hash behind it is not taken in every pass
        folds = stratified_folds(rows, "_row", label, settings.calibration_folds, settings.seed + 1).drop("_row").persist()
        try:
            weighed = folds.groupBy("fold", label).agg(F.first(WEIGHT).alias("weight"), F.count(F.lit(1)).alias("n")).collect()
            total = lambda out: float(sum(r["n"] * r["weight"] for r in weighed if r["fold"] != out))
            vectors = prepared.transform(folds)
            parts = None
            for i in range(settings.calibration_folds):
                held = machine(vectors.where(F.col("fold") != i), total(i)).transform(vectors.where(F.col("fold") == i))
                held = margin.transform(held).select(f"{prefix}m", label)
                parts = held if parts is None else parts.unionByName(held)
            sigmoid = sigmoid_of(parts)
            whole = machine(vectors, total(None))
        finally:
            folds.unpersist()
        return [
            whole,
            margin,
            sigmoid,
            VectorSlicer(inputCol=f"{prefix}p", outputCol="p_svm", indices=[1]),
            _drop(*[f"{prefix}{s}" for s in "vcrmkps"]),
        ]

    return _classifier("svm", features, label, None, True, "balanced", settings, finish, settings.kernel_terms)


def candidates(features: Sequence[str], label: str, settings: Settings = Settings()) -> dict[str, Learner]:
    """The single learners named in the settings, in reporting order."""
    builders = {
        "logistic_regression": logistic_regression,
        "random_forest": random_forest,
        "gradient_boosting": gradient_boosting,
        "svm": support_vector,
    }
    return {name: builders[name](features, label, settings) for name in settings.learners}
