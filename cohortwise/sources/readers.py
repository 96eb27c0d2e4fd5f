"""Reading labelled tables: contract-typed scans, fallbacks between sources and file integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.scalar import nan_to_null, zero_to_null


def read_table(
    spark: SparkSession, paths: str | Sequence[str], contract: Contract | None = None, fmt: str = "csv"
) -> DataFrame:
    """The first path that exists, typed by the contract; without any, ``FileNotFoundError``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    for path in paths:
        try:
            reader = spark.read.format(fmt)
            if fmt == "csv":
                reader = reader.option("header", True)
                if contract is None:
                    reader = reader.option("inferSchema", True)
            return typed(reader.load(path), contract) if contract else reader.load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no table found at {', '.join(paths)}")


def typed(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns cast by name; NaN becomes NULL; other columns pass through."""
    types = {f.name: f.dataType for f in contract.struct().fields}
    out = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if name in types:
            kind = types[name].typeName()
            column = nan_to_null(column) if kind == "double" else column.cast(types[name])
        out.append(column.alias(name))
    return df.select(*out)


def modelling_frame(df: DataFrame, contract: Contract, zero_columns: Sequence[str] | None = None) -> DataFrame:
    """Key, the present contract features in contract order with disguised zeros as NULL, the target."""
    hidden = set(contract.disguised if zero_columns is None else zero_columns)
    have = set(df.columns)
    head = [contract.key] if contract.key and contract.key in have else []
    features = [
        (zero_to_null(F.col(n)) if n in hidden else F.col(n)).alias(n) for n in contract.names if n in have
    ]
    return df.select(*head, *features, contract.target.name)


def load_first(spark: SparkSession, sources: Sequence[tuple[str, str, str]], otherwise) -> tuple[DataFrame, str]:
    """``(name, path, format)`` sources in order, then ``otherwise()``; returns the table and its name."""
    for name, path, fmt in sources:
        try:
            return read_table(spark, path, fmt=fmt), name
        except FileNotFoundError:
            continue
    return otherwise(), "generated"


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes, sha256`` of every file, read through Spark's file systems whatever its size.

    A file is one cell, so it has to stay below Spark's ``binaryFile`` limit of 2 GiB; a larger one is an error.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def require_digest(spark: SparkSession, path: str, expected: str) -> None:
    """Stop unless every file below ``path`` has the expected sha256."""
    wrong = file_digests(spark, path).where(F.col("sha256") != expected).limit(5).collect()
    if wrong:
        found = ", ".join(f"{r['path']}: {r['sha256']}" for r in wrong)
        raise ValueError(f"file sha256 differs from the recorded {expected}: {found}")
