"""Exact top-k by inner product: an impact-ordered index, processed score at a time.

Rows are dealt into blocks; each block's postings (dimension, row) lie by descending quantised impact, the
component's size divided into levels. A query takes segments of all dimensions whose impact, query weight
times level, is above a falling bar, and adds their exact products. What is still untouched in a dimension is
at most the query weight times the next level, which bounds every row's unknown rest. Processing stops only
when the rows whose upper bound reaches the k-th best lower bound are few; these possible members are rescored
exactly. The best k of the blocks are merged.

Every component is an integer and every sum is exact: the levels are cut from the range of the block's components,
and sums that could reach ``EXACT``, beyond which doubles skip integers, are refused with an error.
Queries meet blocks of rows in groups of bounded size; nothing is gathered for all queries or all rows.

Defined cases: rows whose id is null take no part; vectors that are null or hold null or non-finite components take no part; missing trailing
components count as zero, so an empty vector scores 0; ties go to the smaller id; rows with one id are one
candidate each but never meet a query of their own id, and the smallest of their vectors asks; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
#: Levels of the quantised impact.
LEVELS = 256
#: Sums of absolute products below this are exact in doubles.
EXACT = 1 << 53
#: Rescore exactly once so many rows, or this share of the block, can still be members.
FEW_ROWS, FEW_SHARE = 64, 1 / 64
#: Each bar is this share of the one before.
FALL = 0.7


class ImpactIndex:
    """The posting segments of one block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        size = np.abs(self.rows)
        self.largest = size.max(0).astype(float)
        self.step = int(size.max(initial=0)) // LEVELS + 1
        level = size // self.step
        self.postings = np.argsort(-level, axis=0, kind="stable").astype(np.int32).T  # per dimension
        self.levels = -np.sort(-level, axis=0).T
        self.values = np.take_along_axis(self.rows.T, self.postings, axis=1)
        #: per dimension and level, how many postings have at least that level
        self.top = int(level.max()) + 1
        self.at_least = np.stack([np.bincount(column, minlength=self.top + 1)[::-1].cumsum()[::-1] for column in level.T])

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, best first."""
        n = len(self.ids)
        weight = np.abs(query)
        if float(weight @ self.largest) >= EXACT:
            raise ValueError("components too large for exact inner products")
        used = np.flatnonzero(weight)
        mine = self.ids == own
        score = np.zeros(n, np.int64)
        done = np.zeros(len(query), np.int64)
        possible = np.flatnonzero(~mine)
        few = max(FEW_ROWS, k, int(n * FEW_SHARE))
        bar = float((weight[used] * ((self.levels[used, 0] + 1) * self.step)).max()) if len(used) and n else 0.0
        while len(possible) > few and len(used):
            bar *= FALL
            parts, sums = [], []
            # segments whose impact is above the bar: levels beyond bar / weight
            least = np.minimum(np.ceil(bar / (weight[used] * self.step)), self.top).astype(np.int64) if bar >= 1 else 0
            ends = self.at_least[used, least]
            grown = ends > done[used]
            for d, end in zip(used[grown].tolist(), ends[grown].tolist(), strict=True):
                parts.append(self.postings[d, done[d] : end])
                sums.append(query[d] * self.values[d, done[d] : end])
                done[d] = end
            if parts:
                score += np.bincount(np.concatenate(parts), np.concatenate(sums), n).astype(np.int64)
            left = used[done[used] < n]
            rest = int((weight[left] * ((self.levels[left, done[left]] + 1) * self.step - 1)).sum())
            others = score[~mine]
            if len(others) > k:
                floor = np.partition(others, len(others) - k)[len(others) - k] - rest
                possible = np.flatnonzero(~mine & (score + rest >= floor))
            if not rest:
                break
        exact = self.rows[possible] @ query
        best = np.lexsort((self.ids[possible], -exact))[:k]
        return self.ids[possible[best]], exact[best]


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def integer_vectors(df: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v): rows that take part, with components floor(scale * x)."""
    usable = F.col(id_column).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return df.where(usable).select(F.col(id_column).cast("long").alias("id"), v.alias("v"))


def top_k(rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows (id, v) that ``is_query`` holds for, against all others."""
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks, groups = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    dealt = rows.withColumn("block", F.expr(f"pmod(xxhash64(id), {blocks})"))
    asked = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v")).withColumn("grp", F.expr(f"pmod(xxhash64(id, 1), {groups})"))
    # a query group meets every block, a block every query group: one task per pair
    left = dealt.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(key, block, queries):
        vectors, asked_vectors = block.column("v").to_pylist(), queries.column("v").to_pylist()
        width = max([1, *map(len, vectors), *map(len, asked_vectors)])
        found = [[], [], []]
        if vectors and asked_vectors:
            index = ImpactIndex(np.array(block.column("id").to_pylist(), np.int64), _matrix(vectors, width))
            for own, query in zip(queries.column("id").to_pylist(), _matrix(asked_vectors, width), strict=True):
                ids, scores = index.search(query, own, k)
                found[0] += [own] * len(ids)
                found[1] += ids.tolist()
                found[2] += scores.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])

    keys = ["block", "grp"]
    near = left.select(F.col("block").cast("long"), F.col("grp").cast("long"), "id", "v").groupBy(*keys)
    near = near.cogroup(right.select(F.col("block").cast("long"), F.col("grp").cast("long"), "id", "v").groupBy(*keys))
    best = near.applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
