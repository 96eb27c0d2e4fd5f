"""Repeated passages: every fixed-length window of words is hashed, counted in Spark, and removed after its
first document.

Documents are dealt once into batches by a hash of their id; that exchange is shared by the three passes.

1. Every batch hashes all its windows (Rabin-Karp polynomials over word codes) and sends the distinct hashes,
   cut to as many bits as the number of windows calls for and sorted, to the partition of their leading bits,
   packed as differences. There each hash is counted over the batches, and every batch gets one bit per hash
   back: found elsewhere or not. Cutting a hash can only keep a window that is not repeated, never lose one.
2. Windows found in another batch or in another document of the batch go out again with 96 bits of hash and
   the batch's smallest doc_id that has them; one bit per window comes back: is there a smaller one elsewhere.
3. Windows with a smaller document, elsewhere or in the batch, are merged into maximal intervals of words.

A window that occurs in every document is sent once per batch, so no hash makes a partition large, and texts
never leave their batch.

Defined cases: null and empty texts have no words and stay empty; texts shorter than a window lose nothing;
rows with one doc_id count as one document; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, pack, texts_of, unpack, window_codes, word_codes

WIDTH = 13
#: Bytes of text in a batch, and of windows in a counting partition, on average.
BATCH_BYTES = 8 << 20
CELL_WINDOWS = 1 << 21
#: Bits of a cut hash beyond those that number the windows: one window in 2 ** SPARE is kept in vain.
SPARE = 9


class _Batch:
    """The windows of some documents: for each, its document, first word and hash."""

    def __init__(self, table: pa.Table, width: int):
        ids = table.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        texts = texts_of(table)
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] or b"" for i in order]
        self.width = width

    def windows(self, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, index of the document and number of its first word, ordered by document."""
        codes, docs, places = [], [], []
        for rows, texts in chunks(list(range(len(self.texts))), self.texts):
            words, bounds = word_codes(texts, lane)
            found = window_codes(words, self.width, lane)
            size = np.maximum(np.diff(bounds) - self.width + 1, 0)
            local = np.repeat(np.arange(len(texts)), size)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            codes.append(found[bounds[local] + place])
            docs.append(local + rows[0])
            places.append(place)
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        return join(codes).astype(np.uint64), join(docs).astype(np.int32), join(places).astype(np.int32)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.empty(0, np.int64)


def _slices(keys: np.ndarray, shift: int) -> Iterator[tuple[int, int, int]]:
    """(cell, start, end) of sorted keys by their leading bits."""
    cells = (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)
    starts = _runs(cells)
    for start, end in zip(starts, np.append(starts[1:], len(cells)), strict=True):
        yield int(cells[start]), int(start), int(end)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * len(schema), schema, strict=True)], schema=schema)


_SENT = pa.schema([("cell", pa.int64()), ("batch", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_REPLY = pa.schema([("batch", pa.int64()), ("cell", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])
_SENT_SQL, _REPLY_SQL = "cell long, batch long, a binary, b binary, c binary", "batch long, cell long, n long, bits binary"


def _answers(table: pa.Table) -> np.ndarray:
    """The reply bits of a batch, in the order of its sorted keys."""
    parts = sorted(zip(*(table.column(c).to_pylist() for c in ("cell", "n", "bits")), strict=True))
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for _, n, b in parts]
    return np.concatenate(bits) if bits else np.empty(0, bool)


def _reply(rows: list[tuple[int, int]], sizes: list[int], flags: np.ndarray) -> pa.Table:
    """One packed row per sender; flags lie in the senders' order."""
    ends = np.cumsum(sizes)
    return _rows([(b, c, n, np.packbits(flags[e - n : e]).tobytes()) for (b, c), n, e in zip(rows, sizes, ends, strict=True)], _REPLY)


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, object]:
    """The exchange of documents into batches, and the replies of the second pass to each batch."""
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    total = size["bytes"] or 1
    batches = max(1, math.ceil(total / BATCH_BYTES))
    windows = max(2, total // 4)  # more than there can be on average
    bits = min(64, math.ceil(math.log2(windows)) + SPARE)
    cell_bits = max(0, math.ceil(math.log2(windows / CELL_WINDOWS)))
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = docs.select(F.col("doc_id").cast("long"), "text", F.expr(f"pmod(xxhash64(doc_id), {batches})").alias("batch"))
    dealt = dealt.repartition(min(parts, batches) if batches < parts else max(parts, batches // 4), "batch")

    def distinct_keys(batch: _Batch):
        codes, owners, places = batch.windows(0)
        keys = codes >> np.uint64(64 - bits) if bits < 64 else codes
        order = np.argsort(keys, kind="stable")  # within a key by document
        return keys[order], owners[order], places[order], order

    def send_keys(key, table):
        keys, *_ = distinct_keys(_Batch(table, width))
        keys = keys[_runs(keys)]
        rows = []
        for cell, start, end in _slices(keys, bits - cell_bits):
            own = keys[start:end]
            rows.append((cell, key[0].as_py(), pack(np.diff(own, prepend=own[:1])), int(own[0]).to_bytes(8, "little"), None))
        return _rows(rows, _SENT)

    def count_keys(key, table):
        senders, sizes, lists = [], [], []
        for batch, steps, first in zip(*(table.column(c).to_pylist() for c in ("batch", "a", "b")), strict=True):
            own = np.cumsum(unpack(steps), dtype=np.uint64) + np.uint64(int.from_bytes(first, "little"))
            senders.append((batch, key[0].as_py()))
            sizes.append(len(own))
            lists.append(own)
        keys = np.concatenate(lists)
        order = np.argsort(keys, kind="stable")
        starts = _runs(keys[order])
        flags = np.empty(len(keys), bool)
        flags[order] = np.repeat(np.diff(np.append(starts, len(keys))) > 1, np.diff(np.append(starts, len(keys))))
        return _reply(senders, sizes, flags)

    def candidates(batch: _Batch, replies: pa.Table):
        """Windows that may be repeated, ordered by two hashes and then by document."""
        keys, owners, places, order = distinct_keys(batch)
        starts = _runs(keys)
        length = np.diff(np.append(starts, len(keys)))
        ends = starts + length
        local = owners[starts] != owners[ends - 1] if len(starts) else np.empty(0, bool)
        wanted = np.repeat(_answers(replies) | local, length)
        full, other = batch.windows(0)[0][order][wanted], batch.windows(1)[0][order][wanted] >> np.uint64(32)
        owners, places = owners[wanted], places[wanted]
        again = np.lexsort((owners, other, full))
        full, other, owners, places = full[again], other[again], owners[again], places[again]
        new = np.ones(len(full), bool)
        new[1:] = (full[1:] != full[:-1]) | (other[1:] != other[:-1])
        return full, other, owners, places, new

    def send_windows(key, left, right):
        batch = _Batch(left, width)
        full, other, owners, _, new = candidates(batch, right)
        full, other, first = full[new], other[new], batch.ids[owners[new]].view(np.uint64)
        rows = [
            (cell, key[0].as_py(), pack(full[s:e]), pack(other[s:e]), pack(first[s:e]))
            for cell, s, e in _slices(full, 64 - cell_bits)
        ]
        return _rows(rows, _SENT)

    def smallest_documents(key, table):
        columns = [[unpack(x) for x in table.column(c).to_pylist()] for c in "abc"]
        full, other, first = (np.concatenate(c) for c in columns)
        first = first.view(np.int64)
        order = np.lexsort((first, other, full))
        new = np.ones(len(full), bool)
        new[1:] = (full[order][1:] != full[order][:-1]) | (other[order][1:] != other[order][:-1])
        least = first[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        flags = np.empty(len(full), bool)
        flags[order] = least < first[order]
        return _reply([(b, key[0].as_py()) for b in table.column("batch").to_pylist()], [len(x) for x in columns[0]], flags)

    def spans(left: pa.Table, right1: pa.Table, right2: pa.Table):
        batch = _Batch(left, width)
        full, _, owners, places, new = candidates(batch, right1)
        run = np.cumsum(new) - 1
        first = batch.ids[owners[np.flatnonzero(new)]]
        later = batch.ids[owners] > first[run] if len(run) else np.empty(0, bool)
        return batch, owners, places, (_answers(right2)[run] | later) if len(run) else later

    by_cell = lambda rows, f: rows.groupBy("cell").applyInArrow(f, _REPLY_SQL)
    sent = dealt.groupBy("batch").applyInArrow(send_keys, _SENT_SQL)
    first_reply = by_cell(sent, count_keys)
    again = dealt.groupBy("batch").cogroup(first_reply.groupBy("batch")).applyInArrow(send_windows, _SENT_SQL)
    second_reply = by_cell(again, smallest_documents)
    replies = first_reply.withColumn("pass", F.lit(1)).unionByName(second_reply.withColumn("pass", F.lit(2)))
    return dealt, replies, spans


def _marked(dealt: DataFrame, replies: DataFrame, spans, finish, schema: str) -> DataFrame:
    """Runs ``finish(batch, removed)`` for each batch; removed has one mask of words per document."""

    def run(key, left, right):
        passes = np.array(right.column("pass").to_pylist(), np.int64)
        batch, owners, places, cut = spans(left, right.filter(pa.array(passes == 1)), right.filter(pa.array(passes == 2)))
        owners, places = owners[cut], places[cut]
        order = np.lexsort((places, owners))
        owners, places = owners[order], places[order]
        bounds = np.searchsorted(owners, np.arange(len(batch.texts) + 1))
        return finish(batch, [places[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])

    return dealt.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(run, schema)


def _intervals(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal intervals of words covered by windows at the sorted starts."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > width)
    return list(zip(starts[np.concatenate(([0], cuts + 1))].tolist(), (starts[np.concatenate((cuts, [len(starts) - 1]))] + width).tolist(), strict=True))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: n_words, n_removed, kept_text and the removed intervals of words (from, to)."""
    dealt, replies, spans = repeated_spans(docs, width)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
            ("removed", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
        ]
    )

    def finish(batch: _Batch, starts: list[np.ndarray]) -> pa.Table:
        rows = []
        for doc_id, text, own in zip(batch.ids.tolist(), batch.texts, starts, strict=True):
            words, cuts = text.split(), _intervals(own, width)
            kept, at = [], 0
            for start, end in cuts:
                kept += words[at:start]
                at = end
            kept += words[at:]
            rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode(), [{"from": a, "to": b} for a, b in cuts]))
        return _rows(rows, schema)

    return _marked(dealt, replies, spans, finish, "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<`from`: long, `to`: long>>")


def removal_digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: n_words, n_removed and the SHA-256 of the kept words joined by one space."""
    kept = remove_repeats(docs, width)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
