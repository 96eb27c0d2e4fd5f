"""A corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next
one's ``docs``. All but the last return the columns of ``docs``. There is no SQL for the whole: the robust
estimates, the Markov models and the tokenizer have no SQL form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm import mixing, neardup, packing, quality, secret_scan
from cohortwise.llm.common import SMALL_KEYS, if_small, read
from cohortwise.llm.queries import tokenizer_path
from cohortwise.sources.staging import stage


#: Pieces of text that a packing worker remembers: few, since executors still hold what earlier stages left.
KEPT_PIECES = 100_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is among ``ids``."""
    gone = if_small(stage(ids.select(F.col("doc_id").alias("__gone")).distinct(), "gone"), SMALL_KEYS)
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go."""
    return _without(docs, quality.judge(docs).where("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return _without(docs, neardup.near_duplicates(docs).where("not kept"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return secret_scan.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of small sources are repeated up to twice; every document stays at least once."""
    return mixing.replicate(docs)


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), kept=KEPT_PIECES)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", without_secrets),
    ("source mix", source_mix),
    ("packing", packing_plan),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
