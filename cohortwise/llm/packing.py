"""Harmonic packing: lengths in reciprocal-capacity classes, bins with a fixed number of members per class.

The classes are the reciprocals that are powers of two: a member of class i has exactly ``capacity / i``
tokens and a bin takes i members. Documents may be cut freely, so each is cut into full sequences and the
binary parts of its remainder, largest first; every piece then fills its share of a bin exactly. Classes are
filled independently, each split into cells of bounded size that are filled independently too. What a cell
has left over is fewer members than a bin takes; it is closed as sequences of a power-of-two number of
members, whose lengths are powers of two. No sequence has padding.

The ids travel with the pieces and are written as sequences; places, lengths and checksums of the result are
taken from the written sequences. An id takes two bytes if all ids of the tokenizer fit, else four.

Defined cases: a null or empty text has the end id only and is packed as one piece; repeated rows are packed
each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import BATCH_ROWS, arrow_rows, chunks, if_small
from .tokens import Encoder

CAPACITY = 2048
END_ID = 1
#: Pieces of a class filled together; each cell closes at most eleven partly filled bins.
CELL_PIECES = 1 << 16
#: Tokens of the pieces that are filled together, so that a cell of long pieces stays small too.
CELL_TOKENS = 1 << 22
#: Pieces of text that a worker remembers.
KEPT_PIECES = 800_000

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def cut_lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, then the binary parts of the rest from the largest."""
    rest = tokens % capacity
    parts = [1 << k for k in range(capacity.bit_length() - 2, -1, -1) if rest >> k & 1]
    return [capacity] * (tokens // capacity) + parts


def id_type(tokenizer: str, end_id: int = END_ID) -> str:
    """The NumPy type of an id as it is written."""
    top = max(Encoder.of(tokenizer).tokenizer.get_vocab().values(), default=0)
    return "<u2" if max(top, end_id) < 1 << 16 else "<u4"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, kept: int = KEPT_PIECES) -> DataFrame:
    """The pieces of every document, with their ids in ``id_type``; ``kept`` bounds what a worker remembers."""
    end, kind = end_id.to_bytes(4, "little"), id_type(tokenizer, end_id)
    width = np.dtype(kind).itemsize

    def run(batches):
        encoder = Encoder.of(tokenizer, kept)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part, some in chunks(ids, texts):
                rows = []
                for doc_id, encoded in zip(part, encoder.encode(some), strict=True):
                    encoded = np.frombuffer(encoded + end, "<u4").astype(kind).tobytes()
                    total, start = len(encoded) // width, 0
                    for length in cut_lengths(total, capacity):
                        rows.append((doc_id, start, length, total, encoded[width * start : width * (start + length)]))
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def fill(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces whose lengths are powers of two up to ``capacity``.

    Full pieces are sequences of their own. The pieces of a smaller class are spread over cells by a hash;
    within a cell the n-th piece goes to bin ``n // members`` at place ``n % members``, and the last bin is
    split at powers of two.
    """
    classes = found.groupBy("length").agg(F.count(F.lit(1)).alias("class_n"))
    classes = classes.withColumn("cells", F.ceil(F.greatest(F.col("class_n") / CELL_PIECES, F.col("class_n") * F.col("length") / CELL_TOKENS)))
    keyed = found.join(F.broadcast(classes), "length")  # one row per power of two
    keyed = keyed.withColumn("cell", F.expr("pmod(xxhash64(doc_id, start), cells)")).drop("class_n", "cells")
    cell = Window.partitionBy("length", "cell")
    counts = keyed.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    members = (F.lit(capacity) / F.col("length")).cast("long")
    # numbers of sequences: the whole bins, then one for each binary part of the rest
    bins = F.floor(F.col("n") / members)
    counts = counts.withColumn("bins", bins).withColumn("rest", (F.col("n") - bins * members).cast("long"))
    counts = counts.withColumn("sequences", F.col("bins") + F.bit_count("rest"))
    before = Window.orderBy("length", "cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("sequences").over(before), F.lit(0)))
    placed = keyed.withColumn("at", F.row_number().over(cell.orderBy("doc_id", "start")) - 1)
    placed = placed.join(if_small(counts), ["length", "cell"])
    return placed.withColumns(_place(members, capacity))


def _place(members, capacity: int) -> dict:
    """Sequence and offset of the piece number ``at`` of a cell."""
    inside = F.col("at") - F.col("bins") * members  # place in the partly filled last bin, if not below zero
    sequence, offset = F.floor(F.col("at") / members), F.col("at") % members
    taken, number = F.lit(0).cast("long"), F.col("bins")
    for k in range(capacity.bit_length() - 2, -1, -1):  # binary parts of the rest, from the largest
        part = F.col("rest").bitwiseAND(F.lit(1 << k).cast("long"))
        here = (part > 0) & (inside >= taken) & (inside < taken + part)
        sequence, offset = F.when(here, number).otherwise(sequence), F.when(here, inside - taken).otherwise(offset)
        taken, number = taken + part, number + F.when(part > 0, 1).otherwise(0)
    return {
        "sequence_id": (F.col("base") + sequence).cast("long"),
        "offset": (offset * F.col("length")).cast("long"),
    }


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, kept: int = KEPT_PIECES) -> DataFrame:
    """The packed sequences: sequence_id, ids in ``id_type``, and the pieces (doc_id, start, doc_tokens) in their order.

    The pieces of a sequence are equally long, so their places follow from their number.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        found = stage(pieces(docs, tokenizer, capacity, end_id, kept), "pieces", codec="zstd")
    # a sequence is within a cell, so its pieces are together already
    members = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "doc_tokens", "ids"))).alias("members")
    joined = fill(found, capacity).groupBy("length", "cell", "sequence_id").agg(members)
    ids = F.expr("aggregate(members, X'', (ids, m) -> concat(ids, m.ids))").alias("ids")
    held = F.expr("transform(members, m -> struct(m.doc_id, m.start, m.doc_tokens))").alias("pieces")
    return joined.select("sequence_id", ids, held)


def pieces_of(written: DataFrame, kind: str, with_ids: bool = True) -> DataFrame:
    """Every piece of the sequences with its place and checksum, the ids as little-endian unsigned 32-bit binary."""
    width = np.dtype(kind).itemsize
    each = written.withColumn("length", F.expr(f"octet_length(ids) div ({width} * size(pieces))"))
    cut = "struct(p.doc_id, p.start, length, p.doc_tokens, sequence_id, i * length as offset, "
    cut += f"substring(ids, int(i * length * {width} + 1), int(length * {width})) as ids)"
    each = each.select(F.expr(f"inline(transform(pieces, (p, i) -> {cut}))"))

    def run(batches):
        for batch in batches:
            wide = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch.column("ids").to_pylist()]
            columns = {c: batch.column(c) for c in ("doc_id", "start", "length")}
            columns["ids_crc32"] = pa.array(map(zlib.crc32, wide), pa.int64())
            columns |= {c: batch.column(c) for c in ("doc_tokens", "sequence_id", "offset")}
            if with_ids:
                columns["ids"] = pa.array(wide, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return each.mapInArrow(run, schema + ", ids binary" * with_ids)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, kept: int = KEPT_PIECES
) -> DataFrame:
    """Every piece with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Sequences are written with their ids; ``with_ids`` tells whether the result repeats them.
    """
    written = stage(sequences(docs, tokenizer, capacity, end_id, kept), "sequences", codec="zstd")
    return pieces_of(written, id_type(tokenizer, end_id), with_ids)
