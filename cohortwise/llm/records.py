"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

A file is a run of records and a record is

    length of the payload   8 bytes, little-endian
    masked checksum of them 4 bytes
    payload                 1 or 0 for a doc_id or none, doc_id (8 bytes, signed), then the ids (2 bytes each, or 4 if ``wide``)
    masked checksum of it   4 bytes
    line feed               1 byte, the row end of Spark's writer

The checksum is CRC-32 (zlib), masked by a rotation and a constant so that data that contain checksums are
safe. Files lie in folders ``shard=N`` whose order, and the order of records inside, is that of doc_id (null
first, repeated ids by a hash of the text). Files are cut at row quantiles of that order, so sparse or repeated ids make no large file.
``wide`` follows from the tokenizer's largest id. They are written by Spark's own text writer and its commit protocol, and read by its binary file reader, so any
store that Spark reaches will do and a lost task leaves nothing behind. The index has one row per record:
shard, record, position, bytes, doc_id, n_tokens, ids_crc32.

Defined cases: null and empty texts have the end id only; rows with one doc_id, or with none, are written each;
other columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import new_path
from .common import arrow_rows, chunks, if_small
from .tokens import Encoder

END_ID = 2
#: Bytes of text per file, on average.
SHARD_BYTES = 16 << 20
#: Rows that a worker gets at a time.
BATCH_ROWS = 512
_ID = "<?q"
_ID_BYTES = struct.calcsize(_ID)

_INDEX = "shard long, record long, position long, bytes long, doc_id long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def parse(content: bytes | memoryview, wide: bool):
    """(position, bytes, doc_id, ids) of every record; a wrong checksum is an error."""
    at = 0
    while at < len(content):
        length, check = struct.unpack_from("<QI", content, at)
        payload = content[at + 12 : at + 12 + length]
        (found,) = struct.unpack_from("<I", content, at + 12 + length)
        if check != masked(content[at : at + 8]) or found != masked(payload):
            raise ValueError(f"damaged record at byte {at}")
        ids = np.frombuffer(payload, "<u4" if wide else "<u2", offset=_ID_BYTES)
        known, doc_id = struct.unpack_from(_ID, payload)
        yield at, length + 16, doc_id if known else None, ids.astype("<u4")
        at += length + 17


def is_wide(tokenizer: str, end_id: int = END_ID) -> bool:
    """Whether an id needs four bytes."""
    return max(Encoder.of(tokenizer).tokenizer.get_vocab().values(), default=0) >= 1 << 16 or end_id >= 1 << 16


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write the files of ``docs`` in ascending order of doc_id.

    Texts are moved once, to the task that writes their file: a range of (doc_id, hash of the text, row).
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = sized.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    tied = sized.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["doc_id", "tie", "row"]
    dealt = tied.repartitionByRange(max(1, -(-total // shard_bytes)), *order).sortWithinPartitions(*order)
    dealt = dealt.select("doc_id", "text", F.spark_partition_id().cast("long").alias("shard"))
    end, kind = end_id.to_bytes(4, "little"), "<u4" if is_wide(tokenizer, end_id) else "<u2"

    def run(batches):
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id")), strict=True))
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part, some in chunks(rows, texts):
                framed = [
                    frame(struct.pack(_ID, doc_id is not None, doc_id or 0) + np.frombuffer(ids + end, "<u4").astype(kind).tobytes())
                    for (_, doc_id), ids in zip(part, encoder.encode(some), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(framed, pa.binary()), pa.array([s for s, _ in part], pa.int64())], names=["value", "shard"]
                )

    encoded = dealt.mapInArrow(run, "value binary, shard long")
    # the text writer writes a string's bytes as they are
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        encoded.select(F.col("value").cast("string"), "shard").write.partitionBy("shard").text(path)


def scan_records(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """The index of the files, made from their records with every checksum tested."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    numbered = files.select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard"), "content")

    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                rows = [
                    (shard, k, at, size, doc_id, len(ids), zlib.crc32(ids))
                    for k, (at, size, doc_id, ids) in enumerate(parse(memoryview(content.as_buffer()), wide))
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    names = [part.split()[0] for part in _INDEX.split(", ")]
    return numbered.mapInArrow(run, _INDEX)


def write_index(spark: SparkSession, path: str, index_path: str, wide: bool = False) -> DataFrame:
    scan_records(spark, path, wide).write.parquet(index_path)
    return spark.read.parquet(index_path)


def with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids in all records before."""
    sums = index.groupBy("shard").agg(F.sum("n_tokens").alias("own"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    sums = sums.select("shard", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))  # a file has a bounded number of records
    return index.withColumn("local", local).join(if_small(sums), "shard").withColumn("start", F.col("base") + F.col("local")).drop("base", "local")


def shuffled_read(spark: SparkSession, path: str, index: DataFrame, seed: int, wide: bool = False) -> DataFrame:
    """(position, doc_id, ids): every record by its index entry, numbered by a seeded order of the index."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    files = files.select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard"), "content")
    order = index.select("shard", "position", "bytes", F.xxhash64("doc_id", "record", F.lit(seed)).alias("order"))

    def run(key, left, right):
        rows = []
        for content in right.column("content"):
            content = memoryview(content.as_buffer())
            for at, size, order in zip(*(left.column(c).to_pylist() for c in ("position", "bytes", "order")), strict=True):
                _, _, doc_id, ids = next(parse(content[at : at + size], wide))
                rows.append((order, doc_id, ids.tolist()))
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["order", "doc_id", "ids"])

    read = order.groupBy("shard").cogroup(files.groupBy("shard")).applyInArrow(run, "order long, doc_id long, ids array<long>")
    return read.sort("order", "doc_id")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files and their index below the shared folder, and return what the files hold."""
    spark = docs.sparkSession
    path = new_path(spark, "records")
    write_records(docs, path, tokenizer)
    index = write_index(spark, path, new_path(spark, "records-index"), is_wide(tokenizer))
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
