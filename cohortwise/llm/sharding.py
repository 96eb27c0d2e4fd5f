"""Sharding by balanced label propagation: linked documents move together, counts stay at most one apart.

Documents begin in shards of equal counts, in an order of hashes. In every round each link group looks up the
shard where most of its members are; members elsewhere want to move there. Wanted moves are counted per pair of
shards, and as many are made as come back along cycles of shards; documents without links are neutral and go
wherever a place is free. If more rows want a shard than it holds, some of its cut groups are sent where room
is left; a group larger than a shard gets as many shards as it fills. Moves that do not fit wait for a later
round, and rounds end when the cut no longer falls. Since moves in and out of a shard are equal in number, the
law ``rows`` (counts at most one apart) holds after every round. The cut is the number of shards that groups
are in beyond one each.

Members of a group are never gathered or paired: rounds work on counts per group and shard. Orders inside a
shard and quotas are taken in two levels, so no shard is sorted by one task.

Defined cases: a null text has 0 bytes and checksum 0, and null texts are a group; repeated rows are placed
each; fewer documents than shards leave shards empty; other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import SMALL_KEYS, if_small

SHARDS = 40
#: Rounds in a row that may leave the cut as it is before propagation ends.
PATIENCE = 2
#: Bytes that a document takes beside its text.
OVERHEAD = 16
#: Rows of a slice that is ordered by one task, on average.
SLICE_ROWS = 20_000
#: Groups that hold more than one in so many rows are looked up by broadcast; there are fewer than this.
HOT_GROUPS = 1000
#: Groups of more rows are not kept together in the order of moves, so that no slice is large.
SPREAD_ROWS = 1000


def _by_group(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``rows`` left-joined with ``groups`` (grp, n, ...), which has one row per group of ``n`` rows.

    Rows of large groups stay where they are, and so do rows without a group; only the rest is shuffled.
    """
    groups = stage(groups, "groups")
    large = F.col("n") * HOT_GROUPS > total
    hot, rest = F.broadcast(groups.where(large).drop("n")), groups.where(~large).drop("n")
    found = rows.join(hot, "grp")
    others = rows.where("grp is not null").join(hot.select("grp"), "grp", "left_anti").join(if_small(rest, SMALL_KEYS), "grp", "left")
    return found.unionByName(others).unionByName(rows.where("grp is null"), allowMissingColumns=True)


def _ranked(df: DataFrame, keys: list[str], order: list[Column | str], name: str, slices: int, by: Column | None = None) -> DataFrame:
    """Adds the rank from 0 within ``keys``: by slice (``by``, or a hash), then by ``order`` in the slice."""
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)) if by is None else by)
    counts = sliced.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(*order)) - 1
    joined = sliced.withColumn("__at", inside).join(if_small(counts), [*keys, "__slice"])
    return joined.withColumn(name, (F.col("__base") + F.col("__at")).cast("long")).drop("__slice", "__base", "__at")


def propagate(members: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """Adds ``shard`` to rows (doc_id, grp, row_id, ...); rows with the same non-null ``grp`` are linked.

    Without ``rounds``, rounds go on until ``PATIENCE`` of them in a row have not lowered the cut.
    """
    n = members.count()
    slices = max(1, -(-n // SLICE_ROWS))
    sizes = members.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = _by_group(members, sizes.withColumn("linked", F.lit(True)), n)
    ranked = _ranked(marked, [], ["doc_id", "grp"], "rank", slices)
    placed = ranked.withColumn("shard", F.floor(F.col("rank") * shards / F.lit(max(n, 1))).cast("int")).drop("rank")
    best = placed = stage(placed, "shards")
    least, stalled, number = None, 0, 0
    while True:
        counts = placed.where("linked").groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
        groups = counts.groupBy("grp").agg(
            # most members; ties by a hash of the group and shard, so that ties do not all go to one shard
            F.max_by("shard", F.struct("n", F.xxhash64("grp", "shard"))).alias("goal"),
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"),
        )
        groups = stage(groups, "groups")
        cut = groups.agg(F.coalesce(F.sum(F.col("parts") - 1), F.lit(0))).first()[0]
        if least is None or cut < least:
            best, least, stalled = placed, cut, 0
        else:
            stalled += 1
        if not cut or stalled == PATIENCE or number == rounds:
            return best.drop("linked")
        placed, moved = _round(placed, groups, n, shards, max(1, -(-n // (shards * SLICE_ROWS))), number)
        if not moved:
            return best.drop("linked")
        number += 1


def _numbers(values: list, kind: str) -> Column:
    """A constant array, written as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _shares(weights: list[int]) -> list[float]:
    """Upper ends of the intervals of [0, 1) that belong to each weight."""
    total, at, out = sum(weights), 0, []
    for w in weights:
        at += w
        out.append(at / total if total else 2.0)
    return out


def _draw(*columns: Column | str) -> Column:
    """A number of [0, 1) by a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _pick(ends: Column, draw: Column) -> Column:
    """The interval that holds ``draw``."""
    return F.size(F.filter(ends, lambda end: end <= draw))


def _circulate(wanted: dict[tuple[int, int], int], neutral: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wanted moves (from, to) can be made, shard counts unchanged.

    Moves go along cycles of shards, pairs first, until none is left. A cycle may pass one further place, the
    pool: neutral rows of a shard leave to it, and it fills any shard. The table has shards squared entries.
    """
    shards = len(neutral)
    left = [dict() for _ in range(shards + 1)]
    for (s, g), n in sorted(wanted.items()):
        left[s][g] = n
    for s, n in enumerate(neutral):
        if n:
            left[s][shards] = n
        left[shards][s] = sum(wanted.values())

    def path(start: int, end: int, longest: int) -> list[int] | None:
        before, border = {start: start}, [start]
        for _ in range(longest):
            border = [t for s in border for t in left[s] if t not in before and before.setdefault(t, s) == s]
            if end in before:
                way = [end]
                while way[-1] != start:
                    way.append(before[way[-1]])
                return way[::-1]
        return None

    for longest in (1, 2, shards + 1):
        for s, g in sorted(wanted):
            while g in left[s] and (way := path(g, s, longest)):
                arcs = list(zip([s, *way[:-1]], way, strict=True))
                n = min(left[u][v] for u, v in arcs)
                for u, v in arcs:
                    left[u][v] -= n
                    if not left[u][v]:
                        del left[u][v]
    return {(s, g): n - left[s].get(g, 0) for (s, g), n in wanted.items()}


def _wide_moves(counts: DataFrame, sizes: list[int], number: int) -> tuple[Column | None, list[int]]:
    """Where rows of groups larger than a shard want to be, and what these groups leave of each shard.

    Such groups, fewer than shards, get as many shards as they fill, those first where they have most rows.
    ``counts`` has their rows per group and shard.
    """
    own: dict[int, list[int]] = {}
    for r in counts.collect():  # at most shards squared
        own.setdefault(r["grp"], [0] * len(sizes))[r["shard"]] = r["n"]
    free, keep, ends = list(sizes), [], []
    order = sorted(own, key=lambda grp: (-sum(own[grp]), grp))
    for grp in order:
        rest, given = sum(own[grp]), [0] * len(sizes)
        for s in sorted(range(len(sizes)), key=lambda s: (-min(own[grp][s], free[s]), -free[s], s)):
            given[s] = min(free[s], rest)
            free[s] -= given[s]
            rest -= given[s]
        keep += [min(1.0, x / n) if n else 1.0 for x, n in zip(given, own[grp], strict=True)]
        ends += _shares([max(0, x - n) for x, n in zip(given, own[grp], strict=True)])
    if not order:
        return None, free
    first = F.create_map(*[F.lit(x) for i, grp in enumerate(order) for x in (grp, i * len(sizes))])[F.col("grp")]
    stays = _draw("row_id", F.lit(2 * number)) < F.element_at(_numbers(keep, "double"), first + F.col("shard") + 1)
    to = _pick(F.slice(_numbers(ends, "double"), first + 1, F.lit(len(sizes))), _draw("row_id", F.lit(2 * number + 1)))
    return F.when(stays | (to >= len(sizes)), F.col("shard")).otherwise(to), free


def _round(placed: DataFrame, groups: DataFrame, total: int, shards: int, slices: int, number: int) -> tuple[DataFrame, int]:
    """One round of moves, and how many there were. ``groups`` has grp, goal, n and parts."""
    sizes, neutral = [0] * shards, [0] * shards
    for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("linked").isNull()).alias("neutral")).collect():
        sizes[r["shard"]], neutral[r["shard"]] = r["n"], r["neutral"]
    wide = groups.where(F.col("n") > min(sizes))
    of_wide = placed.where("linked").join(F.broadcast(wide.select("grp")), "grp")  # fewer than shards
    wide_goal, free = _wide_moves(of_wide.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n")), sizes, number)
    # goals that more rows want than the shard holds: some of their cut groups go where room is left
    over, spare = [0.0] * shards, list(free)
    narrow = groups.where(F.col("n") <= min(sizes))
    for r in narrow.groupBy("goal").agg(F.sum("n").alias("n"), F.sum(F.expr("if(parts > 1, n, 0)")).alias("open")).collect():
        over[r["goal"]] = min(1.0, max(0, r["n"] - free[r["goal"]]) / max(1, r["open"]))
        spare[r["goal"]] = max(0, free[r["goal"]] - r["n"])
    away = _draw("grp", F.lit(2 * number)) < F.element_at(_numbers(over, "double"), F.col("goal") + 1)
    other = _pick(_numbers(_shares(spare), "double"), _draw("grp", F.lit(2 * number + 1)))
    goal = narrow.where("parts > 1").select(
        "grp", F.when(away & (other < shards), other).otherwise(F.col("goal")).alias("goal"), "n", (F.col("n") > SPREAD_ROWS).alias("spread")
    )
    wanting = _by_group(placed.where("linked"), goal, total)
    if wide_goal is not None:
        wanting = wanting.where("goal is not null").unionByName(of_wide.withColumn("goal", wide_goal).withColumn("spread", F.lit(True)))
    # members of a group are next to each other in the order, so that groups move whole
    by = F.when(F.col("spread"), F.xxhash64("row_id")).otherwise(F.xxhash64("grp"))
    wanting = stage(wanting.where("goal <> shard").withColumn("by", by), "wanting")
    wanting_slices = F.floor(F.pmod("by", F.lit(1 << 30)) * slices / F.lit(1 << 30))
    ranked = _ranked(wanting, ["shard", "goal"], [F.pmod("by", F.lit(1 << 30)), "grp", "row_id"], "place", slices, wanting_slices)
    wanted = {(r["shard"], r["goal"]): r["n"] for r in wanting.groupBy("shard", "goal").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken_moves = _circulate(wanted, neutral)
    table = _numbers([taken_moves.get((s, g), 0) for s in range(shards) for g in range(shards)], "bigint")
    movers = ranked.where(F.col("place") < F.element_at(table, F.col("shard") * shards + F.col("goal") + 1))
    movers = stage(movers, "movers")
    moved = sum(taken_moves.values())
    flow = [0] * shards  # rows that a shard has too many
    for (s, g), n in taken_moves.items():
        flow[s] -= n
        flow[g] += n
    # surplus shards give neutral rows, by rank, to the places that others have free
    starts, taken = {}, 0
    for s in range(shards):
        starts[s] = taken
        taken += max(flow[s], 0)
    ends, free = [], 0
    for s in range(shards):
        free += max(-flow[s], 0)
        ends.append(free)
    surplus = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, max(flow[s], 0))])
    first = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, starts[s])])
    target = F.lit(None).cast("int")
    for s in reversed(range(shards)):
        target = F.when(F.col("given") < ends[s], F.lit(s)).otherwise(target)
    loose = placed.where("linked is null").withColumn("by", F.xxhash64("row_id", F.lit(number)))
    loose = _ranked(loose, ["shard"], ["by", "row_id"], "place", slices)
    sent = F.col("place") < surplus[F.col("shard")]
    loose = loose.withColumn("given", first[F.col("shard")] + F.col("place")).withColumn("shard", F.when(sent, target).otherwise(F.col("shard")))
    # linked rows: the movers by their new shard, the rest as they are
    columns = placed.columns
    went = movers.select("row_id", F.col("goal").alias("to"))
    linked = placed.where("linked").join(went, "row_id", "left").withColumn("shard", F.coalesce("to", "shard"))
    return stage(linked.select(*columns).unionByName(loose.select(*columns)), "shards"), moved


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; equal texts are linked."""
    text = F.col("text")
    base = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce(F.xxhash64(text), F.lit(0)), F.crc32(text.cast("binary")), F.octet_length(text)).alias("grp"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    base = stage(base, "documents")
    placed = propagate(base, shards, rounds)
    slices = max(1, -(-base.count() // (shards * SLICE_ROWS)))
    slotted = _ranked(placed, ["shard"], ["doc_id", "row_id"], "slot", slices)
    return slotted.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
