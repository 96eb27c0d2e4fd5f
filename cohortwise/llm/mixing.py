"""Mixing sources to target weights by temperature, as budgeted block permutations.

A source with token share ``s`` gets the weight ``s ** a / sum(s ** a)``. The exponent ``a`` (one over the
temperature) is found by bisection: the smallest whose weights keep the repetition limit, or the one whose
weights have the target entropy. The budget defaults to the least that repeats no source less than once, so
no document is dropped; a smaller budget takes a part of a source's documents.

A source with ``e`` epochs passes ``floor(e)`` times over all its documents, each pass in an order of its own,
then over the beginning of one more order until the tokens are reached. The stream is cut into blocks; each
block holds the same share of every source, and has an order of its own inside.

All orders come from hashes of doc_id and pass, so they survive retries and need no global sort. Running token
sums over a hot source are taken in two levels: sums per slice of the order, then inside the slices.

Defined cases: a null or empty text has no tokens and is placed by its order alone; a null source is a source;
rows with one doc_id are mixed each, those alike in all columns in any order; sources without tokens pass
once; other columns are ignored (``replicate`` keeps them); empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import if_small

#: Most passes over any source.
REPETITION_LIMIT = 2.0
BLOCK_TOKENS = 1_000_000
#: Documents per slice of an order, on average.
SLICE_ROWS = 20_000
#: Epochs are rounded to so many digits, so that sums in another order give the same plan.
DIGITS = 6
_WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def bisect(wanted, low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The smallest exponent for which ``wanted`` holds, given that it holds from some point on."""
    if wanted(low):
        return low
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if wanted(mid) else (mid, high)
    return high


def exponent_for_repetition(largest: float, smallest: float, limit: float) -> float:
    """With every source passed at least once, the largest share passes once and the smallest most often."""
    return bisect(lambda a: (smallest / largest) ** (a - 1) <= limit)


def exponent_for_entropy(shares: DataFrame, entropy: float, rounds: int = 6, grid: int = 32) -> float:
    """The exponent whose weights have this entropy in nats, bisected many ways at once over the sources."""
    low, high = 0.0, 8.0
    for _ in range(rounds):
        tried = [low + (high - low) * k / grid for k in range(grid + 1)]
        sums = [F.sum(F.pow("share", F.lit(a))).alias(f"z{k}") for k, a in enumerate(tried)]
        sums += [F.sum(F.pow("share", F.lit(a)) * F.log("share")).alias(f"l{k}") for k, a in enumerate(tried)]
        row = shares.where("share > 0").agg(*sums).first()
        if row["z0"] is None:
            return 1.0
        values = [math.log(row[f"z{k}"]) - a * row[f"l{k}"] / row[f"z{k}"] for k, a in enumerate(tried)]
        at = next((k for k in range(grid + 1) if values[k] <= entropy), grid)  # entropy falls as the exponent grows
        low, high = tried[max(at - 1, 0)], tried[at]
    return high


def plan(sized: DataFrame, limit: float | None = REPETITION_LIMIT, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """Per source: rows, source_tokens, share, weight, epochs, passes (whole ones) and rest (tokens of the last)."""
    totals = stage(sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("source_tokens")), "sources")
    ends = totals.agg(F.sum("source_tokens").alias("all"), F.max("source_tokens").alias("hi"), F.min(F.when(F.col("source_tokens") > 0, F.col("source_tokens"))).alias("lo")).first()
    everything, largest, smallest = (float(ends[c] or 1) for c in ("all", "hi", "lo"))
    shares = totals.withColumn("share", F.col("source_tokens") / F.lit(everything))
    if entropy is not None:
        exponent = exponent_for_entropy(shares, entropy)
    else:
        exponent = exponent_for_repetition(largest, smallest, limit or math.inf)
    raw = F.pow("share", F.lit(exponent))
    weighted = shares.withColumn("raw", F.when(F.col("source_tokens") > 0, raw).otherwise(0.0))
    ratio = F.when(F.col("source_tokens") > 0, F.col("raw") / F.col("share"))
    norm = weighted.agg(F.sum("raw").alias("z"), F.min(ratio).alias("least")).first()
    z, least = norm["z"] or 1.0, norm["least"] or 1.0
    # epochs are budget * weight / tokens; the least of them is one unless a budget is given
    factor = 1 / least if budget is None else budget / z / everything
    epochs = F.when(F.col("source_tokens") > 0, F.round(ratio * F.lit(factor), DIGITS)).otherwise(1.0)
    planned = weighted.select("source", "rows", "source_tokens", "share", (F.col("raw") / F.lit(z)).alias("weight"), epochs.alias("epochs"))
    passes = F.floor("epochs")
    rest = F.round((F.col("epochs") - passes) * F.col("source_tokens")).cast("long")
    return planned.withColumn("passes", passes.cast("int")).withColumn("rest", rest)


def order_of(doc_id: Column, number: Column) -> Column:
    """Place of a document in the order of a pass or block: 60 bits of a hash."""
    digest = F.md5(F.concat_ws(":", doc_id.cast("string"), number.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


_ORDERS = 1 << 60


def _running(rows: DataFrame, keys: list[str], slices: Column) -> DataFrame:
    """Adds ``before``: tokens of rows of the same keys earlier in ``place``, in two levels."""
    sliced = rows.withColumn("slice", F.floor(F.col("place") / F.lit(float(_ORDERS)) * slices).cast("long"))
    sums = sliced.groupBy(*keys, "slice").agg(F.sum("tokens").alias("own"))
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "slice", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"))
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "slice"]]
    inside = Window.partitionBy(*keys, "slice").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    joined = local.alias("s").join(if_small(sums).alias("b"), on)
    return joined.select("s.*", (F.col("s.inside") + F.col("b.base")).alias("before")).drop("inside", "slice")


def passes_of(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """One row per document and pass that takes it: doc_id, source, tokens, pass, before (in its pass)."""
    wanted = if_small(planned.select(F.col("source").alias("planned"), "passes", "rest", "rows", "source_tokens"))
    rows = sized.join(wanted, F.col("source").eqNullSafe(F.col("planned"))).drop("planned")
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes") + F.when(F.col("rest") > 0, 1).otherwise(0))))
    rows = rows.withColumn("place", order_of(F.col("doc_id"), F.col("pass")))
    ran = _running(rows, ["source", "pass"], F.ceil(F.col("rows") / SLICE_ROWS))
    return ran.where((F.col("pass") <= F.col("passes")) | (F.col("before") < F.col("rest")))


def mix(docs: DataFrame, limit: float | None = REPETITION_LIMIT, entropy: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixed stream: doc_id, source, tokens, pass, block, position (in the block, from 0)."""
    sized = stage(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), token_count(F.col("text")).alias("tokens")), "sized")
    planned = stage(plan(sized, limit, entropy, budget), "plan")
    taken = stage(passes_of(sized, planned).select("doc_id", "source", "tokens", "pass", "place", "before", "source_tokens"), "passes")
    ends = taken.groupBy("source").agg(F.sum("tokens").alias("taken"))
    # documents without tokens fill blocks too, so that no block is without bound
    total = taken.agg(F.sum(F.greatest("tokens", F.lit(1)))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_tokens))
    ends = if_small(ends.withColumnRenamed("source", "of"))
    spread = taken.join(ends, F.col("source").eqNullSafe(F.col("of")))
    at = (F.col("pass") - 1) * F.col("source_tokens") + F.col("before")
    along = F.when(F.col("taken") > 0, at.cast("double") / F.col("taken")).otherwise(F.col("place") / F.lit(float(_ORDERS)))
    block = F.least(F.floor(along * F.lit(float(blocks))).cast("long"), F.lit(blocks - 1))
    spread = spread.withColumn("block", block)
    inside = Window.partitionBy("block").orderBy(order_of(F.col("doc_id"), F.concat_ws(".", "block", "pass")), "doc_id", "pass")
    position = (F.row_number().over(inside) - 1).cast("long")
    return spread.select("doc_id", "source", "tokens", "pass", "block", position.alias("position"))


def replicate(docs: DataFrame, limit: float | None = REPETITION_LIMIT, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; texts are not moved.

    The last pass of a source is the beginning of an order, so it is decided by one bound per source: the
    place of the first document that it does not take.
    """
    columns = docs.columns
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), token_count(F.col("text")).alias("tokens"))
    sized = stage(sized, "sized")
    planned = stage(plan(sized, limit, entropy, budget), "plan")
    last = passes_of(sized, planned).where(F.col("pass") > F.col("passes"))
    bounds = last.groupBy("source").agg(F.max("place").alias("last_place"))
    bounds = planned.alias("p").join(bounds.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")), "left")
    bounds = stage(bounds.select(F.col("p.source").alias("__of"), F.col("p.passes").alias("__passes"), F.coalesce("last_place", F.lit(-1)).alias("__last")), "bounds")
    joined = docs.join(if_small(bounds), docs["source"].cast("string").eqNullSafe(F.col("__of")))
    place = order_of(docs["doc_id"].cast("long"), F.col("__passes") + 1)
    times = F.col("__passes") + F.when(place <= F.col("__last"), 1).otherwise(0)
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).select(*[docs[c] for c in columns])
