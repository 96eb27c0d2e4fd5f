"""A prefix trie of conversations, packed into double arrays per prefix shard.

A turn is a digest of its role and text; texts do not move. Equal sequences of turns are one row with a count.
Rows are sorted and cut into ranges, the prefix shards. A shard numbers its turns densely, packs its trie into
BASE and CHECK arrays (the child of slot ``s`` by turn ``c`` is slot ``base[s] + c``, where ``check`` says ``s``) and
walks its sequences through them. Nodes on the way to the first or the last sequence of a shard may lie in other
shards too. Every shard therefore also gets the last row before it and the first behind it, and so knows which
nodes, children and leaves are new with it: all numbers of such upper nodes are sums or minima over shards, merged
by one aggregation. All other nodes are whole already and are not moved.

Sequences are cut into segments of ``SEGMENT_TURNS`` turns. A segment's trie hangs below the node that the segments
before it lead to, so a very long conversation is many rows; what lies below a segment's end is summed up first
and handed to the row that ends there.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), then role, then the digest of
the text, and repeated rows are a turn each; rows without conv_id belong to no conversation and are left out;
the lead of a negative conv_id is by truncated division; other columns are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import SMALL_KEYS, if_small
from .mixing import token_count
from .order import ranked

SEGMENT_TURNS = 128
#: Turns per shard, on average.
SHARD_TURNS = 20_000
#: Conversations begin with up to ``MOST_SHARED`` turns of the first one of their group of ``GROUP`` numbers.
GROUP = 20
MOST_SHARED = 3
#: Ids that are written into one piece of text before the pieces of a node are hashed in order.
PIECE_IDS = 4_000
#: Free slots that are tried for several children before they go behind all others.
TRIES = 32

_BYTES = 16
ROOT = bytes(_BYTES)
_TURNS = "array<struct<at:long,turn:binary,words:long>>"
_SUMS = ("n_convs", "n_children", "n_leaves", "spent", "once")
_NODE = (
    "key binary, parent binary, depth long, words long, conv_id long, n_convs long, n_children long, n_leaves long, "
    "spent long, once long, edge boolean, parent_conv long, parent_edge boolean, sub boolean"
)


def _key(data: Column) -> Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, _BYTES)


def _crc(number: Column) -> Column:
    return F.crc32(number.cast("string").cast("binary"))


# --- rebuilt conversations


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id), and their turns (conv_id, at, turn, words) behind the shared beginnings."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("nr"), role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("tie"), token_count(text).alias("words"),
        _key(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn"),
    )
    placed = ranked(stage(rows, "turns"), "conv_id", ["nr", "role", "tie"]).select("conv_id", "at", "turn", "words")
    placed = stage(placed, "places")
    heads = placed.where((F.col("at") < MOST_SHARED) & (F.col("conv_id") % GROUP == 0)).groupBy(F.col("conv_id").alias("lead"))
    heads = stage(heads.agg(F.sort_array(F.collect_list(F.struct("at", "turn", "words"))).alias("turns")), "heads")
    convs = placed.select("conv_id").distinct()
    convs = convs.select("conv_id", (_crc(F.col("conv_id")) % (MOST_SHARED + 1)).cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("lead"))
    convs = convs.join(if_small(heads), "lead", "left")
    convs = stage(convs.select("conv_id", "h", F.coalesce(F.slice("turns", 1, F.col("h")), F.array().cast(_TURNS)).alias("begin")), "conversations")
    begun = convs.select("conv_id", F.explode("begin").alias("t")).select("conv_id", "t.*")
    sizes = if_small(convs.select("conv_id", "h", F.size("begin").alias("begun")), SMALL_KEYS)
    own = placed.join(sizes, "conv_id").where(F.col("at") >= F.col("h"))
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("begun")).alias("at"), "turn", "words")
    return convs.select("conv_id"), begun.unionByName(own)


# --- segments


def segments(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, start, above, base, seq, words, end, goes_on) per segment; a turnless conversation has an empty one.

    ``start`` and ``end`` are the keys of the nodes where a segment begins and ends, ``above`` those of the nodes
    where the segments before began, but for the root. ``seq`` holds the digests of the turns one after another.
    """
    t = turns.groupBy("conv_id", F.floor(F.col("at") / SEGMENT_TURNS).alias("k"))
    t = t.agg(F.sort_array(F.collect_list(F.struct("at", "turn", "words"))).alias("t"))
    seq = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["turn"])), ""))
    cut = stage(t.select("conv_id", "k", seq.alias("seq"), F.transform("t", lambda x: x["words"]).alias("words")), "segments")
    of_conv = Window.partitionBy("conv_id").orderBy("k")  # a row for each SEGMENT_TURNS turns
    chain = F.collect_list(_key(F.col("seq"))).over(of_conv.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    full = F.aggregate("chain", F.lit(ROOT), lambda key, own: _key(F.concat(key, own)))
    rows = cut.withColumn("chain", chain).withColumn("full", full)
    rows = rows.withColumn("before", F.collect_list("full").over(of_conv.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("start", F.coalesce(F.try_element_at("before", F.lit(-1)), F.lit(ROOT)))
    whole = F.length("seq") == SEGMENT_TURNS * _BYTES
    rows = rows.select(
        "conv_id", "start", F.slice("before", 1, F.greatest(F.size("before") - 1, F.lit(0))).alias("above"), (F.col("k") * SEGMENT_TURNS).alias("base"),
        "seq", "words", F.when(whole, F.col("full")).otherwise(_key(F.concat("start", "seq"))).alias("end"),
        F.lead(F.lit(1), 1, 0).over(of_conv).cast("long").alias("goes_on"),
    )
    turnless = convs.join(cut.where("k = 0").select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", F.lit(ROOT).alias("start"), F.array().cast("array<binary>").alias("above"), F.lit(0).cast("long").alias("base"),
        F.lit(b"").alias("seq"), F.array().cast("array<long>").alias("words"), F.lit(ROOT).alias("end"), F.lit(0).cast("long").alias("goes_on"),
    )
    return rows.unionByName(turnless)


# --- a shard's double array


class DoubleArray:
    """A trie over sequences of numbers from 1 on, given sorted and without repetition; slot 0 is its root."""

    def __init__(self, sequences: list[list[int]]):
        self.base, self.check = [0], [0]
        self.children = [0]
        #: All slots but the root's, parents first.
        self.slots: list[int] = []
        self._free = 1
        waiting = [(0, 0, len(sequences), 0)]
        while waiting:
            slot, low, high, depth = waiting.pop()
            if low < high and len(sequences[low]) == depth:
                low += 1
            if low == high:
                continue
            bounds = [low] + [i for i in range(low + 1, high) if sequences[i][depth] != sequences[i - 1][depth]]
            codes = [sequences[i][depth] for i in bounds]
            base = self.base[slot] = self._fit(codes)
            self.children[slot] = len(codes)
            for code, first, last in zip(codes, bounds, [*bounds[1:], high], strict=True):
                self.check[base + code] = slot
                self.slots.append(base + code)
                waiting.append((base + code, first, last, depth + 1))

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more
            self.children += [0] * more

    def _fit(self, codes: list[int]) -> int:
        """A base whose slots for all codes are free: at the first free slots, or behind all used ones."""
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        at = self._free
        for _ in range(TRIES):
            base = at - codes[0]
            self._grow(base + codes[-1] + 1)
            if all(self.check[base + c] < 0 for c in codes):
                return base
            at += 1
            while at < len(self.check) and self.check[at] >= 0:
                at += 1
        base = len(self.check) - codes[0]
        self._grow(base + codes[-1] + 1)
        return base

    def walk(self, sequence: list[int]) -> Iterator[int]:
        """The slots that a sequence leads through, as far as it is in the trie."""
        slot = 0
        for code in sequence:
            child = self.base[slot] + code
            if not 0 < child < len(self.check) or self.check[child] != slot:
                return
            slot = child
            yield slot


def _elements(row: dict) -> list[bytes]:
    seq = row["seq"]
    return [row["start"], *(seq[i : i + _BYTES] for i in range(0, len(seq), _BYTES))]


def _common(a: list[bytes] | None, b: list[bytes] | None) -> int:
    if a is None or b is None:
        return 0
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def shard_nodes(rows: list[dict], before: dict | None, behind: dict | None) -> Iterator[tuple]:
    """The nodes of one shard with what this shard adds to them, in the columns of ``_NODE``.

    The first step of a sequence stands for the node that its segment starts at.
    """
    sequences = [_elements(r) for r in rows]
    old = _common(_elements(before) if before else None, sequences[0])
    kept = _common(sequences[-1], _elements(behind) if behind else None)
    dense = {turn: i for i, turn in enumerate(sorted({x for s in sequences for x in s}), 1)}
    coded = [[dense[x] for x in s] for s in sequences]
    trie = DoubleArray(coded)
    size = len(trie.check)
    n, leaves, spent, once = ([0] * size for _ in range(4))
    conv: list[int | None] = [None] * size
    edge, told = [False] * size, [False] * size
    for i, (row, code) in enumerate(zip(rows, coded, strict=True)):
        path = list(trie.walk(code))
        end = path[-1]
        n[end] += row["n"]
        conv[end] = row["conv_id"]
        leaves[end] += row["more_leaves"]
        spent[end] += row["more_spent"]
        once[end] += row["more_once"]
        extended = trie.children[end] or row["goes_on"] or (i == len(rows) - 1 and kept == len(code))
        leaves[end] += not extended
        edge[end] |= bool(row["goes_on"])
        if i == 0:
            for slot in path[:old]:
                edge[slot] = told[slot] = True
        if i == len(rows) - 1:
            for slot in path[:kept]:
                edge[slot] = True
    words = [0] * size
    for row, code in zip(rows, coded, strict=True):
        for slot, own in zip(trie.walk(code), [0, *row["words"]], strict=True):
            words[slot] = own
    new_children = [0] * size
    for slot in reversed(trie.slots):
        above = trie.check[slot]
        spent[slot] += n[slot] * words[slot]
        once[slot] += 0 if told[slot] else words[slot]
        n[above] += n[slot]
        leaves[above] += leaves[slot]
        spent[above] += spent[slot]
        once[above] += once[slot]
        new_children[above] += not told[slot]
        if conv[slot] is not None and (conv[above] is None or conv[slot] < conv[above]):
            conv[above] = conv[slot]
    keys: dict[int, bytes] = {}
    for row, code in zip(rows, coded, strict=True):
        hashed, above = hashlib.sha256(row["start"]), 0
        for j, slot in enumerate(trie.walk(code)):
            if j:
                hashed.update(row["seq"][(j - 1) * _BYTES : j * _BYTES])
            if slot not in keys:
                keys[slot] = row["start"] if not j else row["end"] if j == SEGMENT_TURNS else hashed.copy().digest()[:_BYTES]
                sums = (new_children[slot], leaves[slot], spent[slot], once[slot])
                if j:
                    own = (keys[above], row["base"] + j, words[slot], conv[slot], n[slot], *sums)
                    yield (keys[slot], *own, edge[slot], conv[above], edge[above] or j == 1, False)
                elif row["base"]:  # the segment before has all of this node but the children
                    yield (keys[slot], None, row["base"], None, None, 0, *sums, True, None, None, True)
                else:
                    yield (keys[slot], None, 0, 0, conv[slot], n[slot], *sums, True, None, None, False)
            above = slot


# --- all shards


def _trie_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of all shards; those that may be in several (``edge``) are one row per shard."""
    turns, count = rows.agg(F.sum(F.length("seq") / _BYTES + 1), F.count(F.lit(1))).first()
    shards = max(1, int(-(-(turns or 0) // SHARD_TURNS)))
    held = stage(rows.repartitionByRange(shards, "start", "seq").withColumn("shard", F.spark_partition_id()), "shards")
    place = F.struct("start", "seq")
    ends = held.groupBy("shard").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    in_order = Window.orderBy("shard")  # one row per shard
    ends = ends.select("shard", F.lag("last").over(in_order).alias("before"), F.lead("first").over(in_order).alias("behind"))
    none = {c: F.lit(None).cast(t) for c, t in rows.dtypes if c not in ("start", "seq")}
    near = [
        ends.where(F.col(side).isNotNull()).select(f"{side}.start", f"{side}.seq", *[v.alias(c) for c, v in none.items()], "shard", F.lit(k).alias("side"))
        for k, side in ((-1, "before"), (1, "behind"))
    ]
    names = [part.split()[0] for part in _NODE.split(", ")]
    types = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
    kinds = [types[part.split()[1]] for part in _NODE.split(", ")]

    def run(table):
        given = sorted(table.to_pylist(), key=lambda r: (r["start"], r["seq"]))
        own = [r for r in given if not r["side"]]
        sides = {r["side"]: r for r in given if r["side"]}
        found = list(zip(*shard_nodes(own, sides.get(-1), sides.get(1)), strict=True)) or [()] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=names)

    everything = held.withColumn("side", F.lit(0)).unionByName(near[0]).unionByName(near[1])
    return everything.groupBy("shard").applyInArrow(run, _NODE)


def nodes(cut: DataFrame) -> DataFrame:
    """(key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) of the trie of segments."""
    rows = cut.groupBy("start", "seq").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.sum("goes_on").alias("goes_on"),
        *[F.first(c).alias(c) for c in ("above", "base", "words", "end")],
    )
    rows = stage(rows, "sequences")
    more = ("leaves", "spent", "once")
    rows = rows.select("*", *[F.lit(0).cast("long").alias(f"more_{c}") for c in more])
    if rows.where("base > 0").limit(1).count():
        rows = _with_what_is_below(rows)
    found = stage(_trie_nodes(rows.drop("above")), "nodes")
    for c in ("n_leaves", "spent", "once"):
        found = found.withColumn(c, F.when(F.col("sub"), 0).otherwise(F.col(c)))
    upper = found.where("edge").groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("parent", "depth", "words")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in _SUMS], F.max("parent_conv").alias("parent_conv"), F.max("parent_edge").alias("parent_edge"),
    )
    upper = stage(upper, "upper")
    whole = found.where("not edge").select(*upper.columns).unionByName(upper)
    above = if_small(upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("upper_conv")))
    whole = whole.join(above, "parent", "left")
    return whole.select(
        "key", "conv_id", "depth", F.when(F.col("parent_edge"), F.col("upper_conv")).otherwise(F.col("parent_conv")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", (F.col("spent") - F.col("once")).alias("saved_tokens"),
    )


def _with_what_is_below(rows: DataFrame) -> DataFrame:
    """Adds to every row what all later segments below its end amount to."""
    own = _trie_nodes(rows.where("base > 0").drop("above")).where("sub").groupBy("key")
    own = stage(own.agg(*[F.sum(c).alias(c) for c in ("n_leaves", "spent", "once")]), "below")
    starts = rows.where("base > 0").groupBy(F.col("start").alias("key")).agg(F.first("above").alias("above"))
    chains = own.join(starts, "key").withColumn("to", F.explode(F.concat("above", F.array("key"))))
    below = chains.groupBy(F.col("to").alias("end")).agg(*[F.sum(c).alias(c) for c in ("n_leaves", "spent", "once")])
    met = rows.drop("more_leaves", "more_spent", "more_once").join(stage(below, "below"), "end", "left")
    for c, name in (("n_leaves", "more_leaves"), ("spent", "more_spent"), ("once", "more_once")):
        met = met.withColumn(name, F.coalesce(c, F.lit(0)))
    return stage(met.drop("n_leaves", "spent", "once"), "sequences")


# --- who ends where


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): SHA-256 of the ids in order, comma-joined.

    Ids are joined to pieces of bounded size over ranges of (key, conv_id), so a node where most conversations end is
    prepared by many tasks; the pieces are hashed as a stream, a batch at a time.
    """

    def pieces(batches):
        key, ids = None, []
        for batch in batches:
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (k != key or len(ids) == PIECE_IDS):
                    yield _piece(key, ids)
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield _piece(key, ids)

    def digests(batches):
        key, hashed = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k == key:
                    hashed.update(b"," + ids.encode())
                    continue
                if hashed:
                    done.append((key, hashed.hexdigest()))
                key, hashed = k, hashlib.sha256(ids.encode())
            if done:
                yield _digests(done)
        if hashed:
            yield _digests([(key, hashed.hexdigest())])

    size = max(1, ends.count() // 200_000)
    joined = ends.repartitionByRange(size, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = joined.mapInArrow(pieces, "key binary, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


def _piece(key: bytes, ids: list[int]) -> pa.RecordBatch:
    text = ",".join(map(str, ids))
    return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([text])], names=["key", "first", "ids"])


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, digests = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests)], names=["key", "ends_sha256"])


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row for every node of the trie of rebuilt conversations."""
    cut = stage(segments(*rebuilt(conversations)), "segments")
    ends = stage(end_digests(cut.where("goes_on = 0").select(F.col("end").alias("key"), "conv_id")), "ends")
    found = nodes(cut).join(ends, "key", "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", nobody)).drop("key")
