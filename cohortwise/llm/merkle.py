"""A Merkle manifest of a table: one digest per row, a tree per group, and a tree over the groups' roots.

A level of the tree is kept as one hex string per aligned block of ``BLOCK`` nodes. Parents are digests of
fixed-width substrings of it, one for each run of ``FAN`` nodes; a node's siblings are the substrings that
flank it in its run. A block ends in one node after ``BLOCK_LEVELS`` levels, and the nodes of all blocks are
the leaves of the next round, until every group has one node. The roots of the groups are the leaves of one
more such tree. Way back down, every block hands the path of its last node to its members, so a proof needs no
look-up of single nodes.

A block is bounded (``BLOCK`` nodes), so a group with most of the rows is many blocks; the places of rows in
their group come from ranges of the order. The driver sees one number per round.

Defined cases: null fields count as ``-``; a null group and a null key come first in their orders; rows that
are alike in key and digest have neighbouring places, dealt out in any order, rows of one key with other
content are ordered by their digests; a group of one row is its own root; other columns are ignored; an empty
table has no rows and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .order import ranked

FAN = 8
BLOCK_LEVELS = 3
BLOCK = FAN**BLOCK_LEVELS
_HEX = 64
_RUN = FAN * _HEX
_PATH = "array<struct<left:string,right:string>>"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(field: Column) -> Column:
    """A field with its length in bytes before it, so that no two rows are encoded alike."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return digest(F.concat(*[encoded(f) for f in fields]))


def _parents(level: Column) -> Column:
    """The next level's string: a digest for each run, the last of which may be short."""
    runs = F.ceil(F.length(level) / _RUN).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: digest(F.substring(level, i * _RUN + 1, F.lit(_RUN)))), "")


def _blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Blocks of nodes (grp, at, n, node): their members, the strings of their levels and their last node."""
    member = F.struct("at", "node", *payload)
    blocks = nodes.groupBy("grp", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members")
    )
    height = F.lit(0)
    for k in range(1, BLOCK_LEVELS + 1):
        height = F.when(F.col("n") > FAN ** (k - 1), k).otherwise(height)
    blocks = blocks.withColumn("height", height).withColumn("level0", F.array_join(F.transform("members", lambda m: m["node"]), ""))
    top = F.col("level0")
    for k in range(1, BLOCK_LEVELS + 1):
        blocks = blocks.withColumn(f"level{k}", F.when(F.col("height") >= k, _parents(F.col(f"level{k - 1}"))))
        top = F.coalesce(F.col(f"level{k}"), top)
    return blocks.withColumn("top", top).drop(f"level{BLOCK_LEVELS}")


def _climb(nodes: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and one node per group."""
    rounds = []
    while True:
        blocks = stage(_blocks(nodes, [] if rounds else payload), "levels")
        rounds.append(blocks)
        nodes = blocks.select("grp", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"))
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds, nodes.select("grp", "node")


def _flanks(place: Column) -> Column:
    """The siblings of a block's member, level by level: the substrings left and right of it in its run."""
    steps = []
    for k in range(BLOCK_LEVELS):
        at = F.floor(place / FAN**k).cast("int")
        run, inside, level = F.floor(at / FAN).cast("int") * _RUN + 1, at % FAN, F.col(f"level{k}")
        left = F.substring(level, run, inside * _HEX)
        right = F.substring(level, run + (inside + 1) * _HEX, (FAN - 1 - inside) * _HEX)
        steps.append(F.when(F.col("height") > k, F.struct(left.alias("left"), right.alias("right"))))
    return F.array_compact(F.array(*steps))


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The members of the first round with their whole ``path``; ``tops`` has grp, the path above it and more."""
    rows = tops.withColumn("at", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        above = rows.withColumnRenamed("at", "block").withColumnRenamed("path", "above").drop("node")
        levels = [f"level{k}" for k in range(BLOCK_LEVELS)]
        met = blocks.drop("n", "top").join(above, ["grp", "block"]).withColumn("m", F.explode("members")).drop("members")
        path = F.concat(_flanks(F.col("m.at") - F.col("block") * BLOCK), "above")
        rows = met.withColumn("path", path).select("*", "m.*").drop("m", "above", "block", "height", *levels)
    return rows


def build(leaves: DataFrame, group: str, order: list[str], payload: list[str]) -> DataFrame:
    """(payload, leaf, subroot, root, path) for staged ``leaves`` (leaf, group, order, payload)."""
    # a mark before the value keeps the order and gives null a place before all
    keyed = leaves.withColumn("grp", F.coalesce(F.concat(F.lit(":"), F.col(group)), F.lit("-"))).withColumnRenamed("leaf", "node")
    nodes = ranked(keyed, "grp", [*order, "node"]).select("grp", "at", "n", "node", *payload)
    rounds, subroots = _climb(nodes, payload)
    subroots = stage(subroots.select(F.lit("").alias("all"), F.col("grp").alias("name"), "node"), "subroots")
    nodes = ranked(subroots, "all", ["name"]).select(F.col("all").alias("grp"), "at", "n", "node", "name")
    upper, root = _climb(nodes, ["name"])
    tops = root.select("grp", F.col("node").alias("root"), F.array().cast(_PATH).alias("path"))
    tops = _descend(upper, tops).select(F.col("name").alias("grp"), F.col("node").alias("subroot"), "root", "path")
    return _descend(rounds, tops).drop("grp", "at").withColumnRenamed("node", "leaf")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def verify_documents(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every document; documents whose number's checksum is divisible by three are tampered with."""
    fields = {name: F.col(name) for name in DOCUMENT_FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = leaf(*(fields | {"text": F.translate("text", _CAPITALS, _SMALL)}).values())
    leaves = docs.select("doc_id", "lang", leaf(*fields.values()).alias("leaf"), F.when(tampered, changed).alias("changed"))
    proved = build(stage(leaves, "leaves"), "lang", ["doc_id"], ["doc_id", "changed"])
    proved = proved.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
