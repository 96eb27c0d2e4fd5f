"""The published model: a saved pipeline and a JSON table beside it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import placeholder_score
from ..functions.scalar import decide
from .pipelines import probability

# Fixed value: decision threshold while no model is published.
PLACEHOLDER_THRESHOLD = 0.5


@dataclass(frozen=True)
class Scorer:
    """Adds probability, label and source to any table, static or streaming, that has the features."""

    features: tuple[str, ...]
    threshold: float
    source: str
    model: PipelineModel | None = None
    output: str | None = None

    def score(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            scored = df.withColumn("probability", placeholder_score({c: F.col(c) for c in self.features}))
        else:
            scored = self.model.transform(df).withColumn("probability", probability(self.output)).drop(self.output)
        return scored.withColumn("label", decide(F.col("probability"), self.threshold)).withColumn(
            "source", F.lit(self.source)
        )


def trained_at() -> Column:
    """Spark's clock in the session's time zone, to the second."""
    return F.date_trunc("second", F.current_timestamp()).cast("string")


def publish(
    spark: SparkSession, path: str, model: PipelineModel, output: str, threshold: float, features: Sequence[str]
) -> None:
    model.write().overwrite().save(f"{path}/pipeline")
    facts = spark.createDataFrame(
        [(output, float(threshold), list(features))], "output string, threshold double, features array<string>"
    )
    facts.withColumn("trained_at", trained_at()).coalesce(1).write.mode("overwrite").json(f"{path}/facts")


def load_scorer(spark: SparkSession, path: str, features: Sequence[str]) -> Scorer:
    """The published model when there is one, else the deterministic placeholder."""
    schema = "output string, threshold double, features array<string>, trained_at string"
    try:
        facts = spark.read.schema(schema).json(f"{path}/facts").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        facts = None
    if facts is None:
        return Scorer(tuple(features), PLACEHOLDER_THRESHOLD, "placeholder")
    model = PipelineModel.load(f"{path}/pipeline")
    return Scorer(tuple(facts["features"]), facts["threshold"], "trained", model, facts["output"])
