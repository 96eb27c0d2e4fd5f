"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into ``SEGMENTS`` segments. Its entries in the table of a segment are the Hamming ball of
radius 1 inside that segment, with the other segments as they are; they are part of the key, since a segment
alone is shared by a whole family of copies, whose pairs would all have to be tested. Two fingerprints differ by
at most two bits exactly where they share an entry: both have the one between them. ``verified`` compares the
whole fingerprints of all that the tables return.

Equal fingerprints are one member, so an entry has at most 65 holders (its own ball) whatever the corpus holds:
no bucket grows with the input, none is compared pair by pair and none is capped. All holders of an entry lie
within two bits of each other, so links to the smallest of them connect what all pairs would.

Defined cases: null, empty and wordless texts have the fingerprint zero and are linked like any other; texts of
fewer words than a shingle are one shingle; repeated rows are a row each, of one component; a component
whose ids are all null has a null component_id; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import texts_of
from .links import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
BITS = 64
SEGMENTS = 2
#: Bytes of a text whose words are held as objects at a time.
SLICE_BYTES = 1 << 18

#: Fingerprints whose entries one task makes.
MEMBER_ROWS = 20_000

_BLANKS = b" \t\n\x0b\x0c\r"


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some at a time: no slice ends inside a word."""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        while end < len(text) and text[end] not in _BLANKS:
            end += 1
        yield text[start:end].split()
        start = end


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the hashes of all shingles, repeats included."""
    one_hash = partial(xxhash.xxh64_intdigest, seed=seed)
    ones, total, carried = np.zeros(BITS, np.int64), 0, []
    for words in _slices(text.lower()):  # of bytes: A-Z only
        words = carried + words
        carried = words[max(0, len(words) - width + 1) :]
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
        hashes = np.fromiter(map(one_hash, shingles), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    if not total:
        return one_hash(b" ".join(carried)) if carried else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t or b"", width) for t in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def ball(fp: Column, segment: int, segments: int = SEGMENTS) -> Column:
    """The fingerprints that differ from ``fp`` by one bit inside a segment."""
    width = BITS // segments
    flips = [1 << bit for bit in range(segment * width, (segment + 1) * width)]
    masks = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("long") for m in flips])
    return F.transform(masks, lambda mask: fp.bitwiseXOR(mask))


def entries(fp: Column, segments: int = SEGMENTS) -> Column:
    """The keys of a fingerprint in all tables; the centre, which all balls share, is there once."""
    return F.concat(F.array(fp), *[ball(fp, s, segments) for s in range(segments)])


def verified(links: DataFrame, distance: int = DISTANCE) -> DataFrame:
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def table_matches(members: DataFrame) -> DataFrame:
    """Links (a, b) between members (fp) that share an entry, one for each holder beside the smallest."""
    # written members are few bytes for many entries: they are dealt out by their number
    members = members.repartition(max(1, -(-members.count() // MEMBER_ROWS)))
    # an entry of one table can be a centre, or another table's entry, of the other side: all tables are matched at once
    held = members.select("fp", F.explode(entries(F.col("fp"))).alias("key")).groupBy("key").agg(F.collect_set("fp").alias("holders"))
    first = F.array_min("holders")
    return held.where(F.size("holders") > 1).select(first.alias("a"), F.explode("holders").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint and component_id, the smallest doc_id linked to it, directly or not."""
    known = stage(fingerprints(docs), "fingerprints")
    members = stage(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "members")
    roots = components(verified(table_matches(members)))
    rooted = members.join(roots, members["fp"] == roots["id"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = stage(rooted.join(smallest, "root").select("fp", "component_id"), "found")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return known.join(found, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
