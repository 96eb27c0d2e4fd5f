"""Shared pieces of the training-data operators: reading, hashing of words in batches, framing of arrays."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handled by one call of the vectorised hashing, so that its arrays stay below about 100 MB.
CHUNK_BYTES = 1 << 21
#: Whole texts that a worker gets at a time. Larger batches stay in the memory of workers that wait for later stages.
BATCH_ROWS = 512
#: Tables of at most so many rows (a few hundred bytes each) are broadcast; larger ones are joined by shuffle.
SMALL_ROWS = 20_000
#: The same for tables that hold a key and one number.
SMALL_KEYS = 500_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``rows`` rows, else as it is.

    A larger table is joined by shuffle, where adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(df) if df.select(F.lit(1)).limit(rows + 1).count() <= rows else df


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Actions inside hand at most ``rows`` rows to Python at once, so that long texts stay a few megabytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before) if int(before) > 0 else rows)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit of 64-bit integers over all output bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def chunks(rows: list, texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Consecutive rows whose texts have about ``limit`` bytes together; a longer text is alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield rows[start:i], texts[start:i]
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield rows[start:], texts[start:]


def word_codes(texts: list[bytes], lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code for every word ``[^\\x20\\x09-\\x0D]+`` of the texts, and where each text's words begin.

    The code is a polynomial over the word's bytes; ``lane`` chooses independent coefficients. The second
    array has one entry more than there are texts.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~_SPACE[data]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate(([0], np.searchsorted(starts, ends_of_texts)))
    if not len(starts):
        return np.empty(0, np.uint64), bounds
    values = np.where(_SPACE, np.uint64(0), odd_numbers(256, 1000 * lane + 7) >> np.uint64(1))[data[starts[0] :]]
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(len(values)) - np.repeat(starts - starts[0], spans)
    base = odd_numbers(1, 1000 * lane + 11)[0]
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(spans.max()), base))), dtype=np.uint64)
    return mix(np.add.reduceat(values * powers[place], starts - starts[0])), bounds


def window_codes(words: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Polynomial hash of every run of ``width`` consecutive word codes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = odd_numbers(1, 1000 * lane + 13)[0]
    code = words[:n].copy()
    for k in range(1, width):
        code = code * base + words[k : k + n]
    return mix(code)


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as compressed byte planes; constant high bytes cost nothing."""
    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def texts_of(batch: pa.RecordBatch | pa.Table, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return batch.column(column).cast(pa.binary()).to_pylist()
