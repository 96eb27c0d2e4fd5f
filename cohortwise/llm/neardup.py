"""MinHash near-duplicates by tensored banding, confirmed on full shingle sets.

Two collections of ``TABLES`` half keys are computed per document, each from ``HALF`` minimum hashes. Every
pair of a half key of the first collection with one of the second is a table key, so ``TABLES`` squared tables
of ``2 * HALF`` hashes cost only ``2 * TABLES * HALF`` minimum hashes.

Documents with the same shingle set are one member first. Members that share a table key are compared with
two members of that key (its smallest and largest id, found by aggregation), never pairwise. Confirmed links
are contracted; where a key still holds several components, its members go through an exact prefix join
across components, so that no pair that shares a key stays untested. Nothing is capped.

Table keys are only made of half keys that several members hold: a key that two members share has both of its
halves in common, so nothing is lost, and members that are like no other make no keys.

With the defaults, a pair at similarity 0.8 shares no key with probability 0.002 %, at 0.9 with less than
one in a billion; a group of copies has many such pairs.

Defined cases: null, empty and wordless texts have an empty set and are linked with nothing; texts with fewer
words than a shingle have one shingle, the whole sequence; repeated rows with one doc_id are one member; other
columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import BATCH_ROWS, arrow_rows, chunks, mix, odd_numbers, texts_of, window_codes, word_codes

SHINGLE = 5
#: Percent of the union that the intersection must reach.
SIMILARITY = 80
TABLES = 16
HALF = 3


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle codes of each text."""
    codes, bounds = word_codes([t.lower() for t in texts])
    sets = []
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        own = codes[start:end]
        sets.append(np.unique(window_codes(own, min(width, len(own)))) if len(own) else own)
    return sets


def _half_keys(codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """``2 * TABLES`` keys, each from ``HALF`` minimum hashes under multiply-and-shift."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(codes), 4096):
        hashed = codes[start : start + 4096, None] * factors[None, :]
        least = np.minimum(least, (hashed >> np.uint64(20)).min(0))
    bands = least.reshape(-1, HALF)
    key = np.zeros(len(bands), np.uint64)
    for k in range(HALF):
        key = mix(key + bands[:, k])
    return key


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Per document its set's size and digest, and the two collections of half keys."""
    factors = odd_numbers(2 * TABLES * HALF, 5)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or b"" for t in texts_of(batch)]
            for part, some in chunks(ids, texts):
                sets = shingle_sets(some, width)
                keys = [_half_keys(s, factors).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([None if k is None else k[:TABLES] for k in keys], pa.list_(pa.int64())),
                        pa.array([None if k is None else k[TABLES:] for k in keys], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "digest", "first", "second"],
                )

    schema = "doc_id long, n long, digest binary, first array<long>, second array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or b"" for t in texts_of(batch)]
            for part, some in chunks(ids, texts):
                sets = [s.view(np.int64) for s in shingle_sets(some, width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "codes"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "id long, codes array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("codes").alias("codes_b")), "b")
    both = both.join(sets.select(F.col("id").alias("a"), F.col("codes").alias("codes_a")), "a")
    common = F.size(F.array_intersect("codes_a", "codes_b")).cast("long")
    union = F.size("codes_a") + F.size("codes_b") - common
    return both.where(100 * common >= similarity * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in the links; root is the smallest id that can be reached.

    Alternates two contractions, each one aggregation and one join on links only: every id hands its larger
    neighbours to its smallest neighbour, then its smaller ones. Ends when the links are stars.
    """

    def contract(edges: DataFrame, larger: bool) -> DataFrame:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        handed = sides.join(least, "u")
        if larger:
            handed = handed.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        else:
            own = least.select("u", F.col("least").alias("v"))
            handed = handed.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(own)
        return handed.where("u <> v").distinct()

    def mark(edges: DataFrame):
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = mark(edges)
    while before[0]:
        edges = stage(contract(contract(edges, True), False), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root"))).groupBy("id").agg(F.min("root").alias("root"))


def _across(shared: DataFrame, sets: DataFrame, roots: DataFrame, similarity: int) -> DataFrame:
    """Untested candidate pairs between components that still meet in a key, by an exact prefix join.

    Two sets that must have ``need`` codes in common share one among the first ``n - need + 1`` of each, in any
    common order; rare codes come first, so that what sets that are not similar share comes too late to pair
    them. Codes found in one component only are left out before anything is paired.
    """
    rooted = shared.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    open_ids = rooted.join(mixed.select("key"), "key", "left_semi").select("id", "root").distinct()
    open_sets = open_ids.join(sets, "id")
    codes = open_sets.select("id", "root", F.size("codes").alias("n"), F.explode("codes").alias("code"))
    frequency = codes.groupBy("code").agg(F.count(F.lit(1)).alias("df"))
    ordered = codes.join(frequency, "code").groupBy("id", "root", "n").agg(F.sort_array(F.collect_list(F.struct("df", "code"))).alias("codes"))
    need = F.ceil(F.col("n") * similarity / 100)  # with the smallest or largest partner
    prefix = ordered.select("id", "root", "n", F.posexplode(F.slice("codes", F.lit(1), F.col("n") - need.cast("int") + 1)).alias("at", "c"))
    prefix = prefix.select("id", "root", "n", "at", "c.code")
    several = prefix.groupBy("code").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    prefix = stage(prefix.join(several.select("code"), "code", "left_semi"), "prefix")
    a, b = (prefix.select("code", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "root", "n", "at")]) for s in "ab")
    common = F.ceil((F.col("n_a") + F.col("n_b")) * similarity / (100 + similarity))
    met = a.join(b, "code").where(
        (F.col("root_a") < F.col("root_b"))
        & (F.col("at_a") <= F.col("n_a") - common)
        & (F.col("at_b") <= F.col("n_b") - common)
    )
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """Per document: n_shingles, component_id (smallest doc_id linked to it, directly or not) and kept."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        known = stage(sketches(docs, width), "sketches")
    members = known.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("first", "second")])
    members = stage(members, "members")
    halves = members.select("id", F.posexplode(F.concat("first", "second")).alias("i", "x"))
    held = halves.groupBy("i", "x").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    halves = stage(halves.join(held.select("i", "x"), ["i", "x"], "left_semi"), "halves").groupBy("id")
    half = halves.agg(*[F.collect_list(F.when(side, F.struct("i", "x"))).alias(c) for c, side in (("first", F.col("i") < TABLES), ("second", F.col("i") >= TABLES))])
    keys = half.select("id", "second", F.explode("first").alias("a")).select("id", "a", F.explode("second").alias("b"))
    keys = keys.select("id", F.col("a.i").alias("i"), F.col("a.x").alias("x"), F.col("b.i").alias("j"), F.col("b.x").alias("y"))
    keys = keys.select("id", F.xxhash64("i", "x", "j", "y").alias("key"))
    leads = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    shared = stage(keys.join(leads, "key"), "keys")
    star = shared.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("id").alias("b")), F.struct(F.col("id").alias("a"), F.col("hi").alias("b")))).alias("p"))
    pairs = stage(star.select("p.*").where("a < b").distinct(), "pairs")
    involved = shared.select(F.col("id").alias("doc_id")).distinct()
    once = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(involved, "doc_id", "left_semi")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        sets = stage(_sets(once, width).groupBy("id").agg(F.first("codes").alias("codes")), "sets")
    links = stage(confirmed(pairs, sets, similarity), "links")
    roots = components(links)
    rest = _across(shared.select("id", "key"), sets, roots, similarity).join(pairs, ["a", "b"], "left_anti")
    links = links.unionByName(confirmed(rest, sets, similarity))
    roots = components(links)
    by_digest = members.join(roots, "id", "left").select("digest", F.coalesce("root", "id").alias("component_id"))
    found = known.select("doc_id", "n", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
