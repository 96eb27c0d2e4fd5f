"""Writing tables, previews and the metrics document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a folder of part files, one per task; CSV parts carry the header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def preview(df: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(F.col(key)).limit(rows)
