"""Nearest-neighbour imputation: a missing cell becomes the mean of that column over the k nearest rows.

The distance of two rows is taken over the columns both have: ``sqrt(columns / shared * sum of squares)``.
Equal rows are one donor with a number of copies. Of donors at the same distance the smaller value
comes first, so the result does not depend on row order.

Rows with the same columns present meet donors with the same columns present in one space of fixed columns, so
their neighbours are found in a balanced tree of boxes. A donor set of checked size is broadcast. A larger one is
cut into cells by a tree over the widest columns. A row first asks the cell it lies in. The distances found there
bound from above how far its neighbours can be, and only the cells whose boxes come nearer are asked as well, which
few rows need. The outcome is the same, exact one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null
from ..sources.staging import stage
from .lookup import HOT_SHARE

#: distinct donor rows that may be broadcast
DONOR_ROWS = 20_000
#: donors one cell aims at, visiting rows one task group may hold, and boxes the box table aims at
CELL_ROWS = 10_000
VISIT_ROWS = 20_000
MAX_CELLS = 100_000
#: rows of the sample that places the cuts between cells, per cell; the cuts decide balance only
CUT_ROWS = 50
#: candidates one merging group may hold
MERGE_ROWS = 500_000
#: donors in a leaf of a tree, rows that go down a tree together, and distances computed at once inside a task
_LEAF = 24
_TOGETHER = 2048
_BLOCK = 500_000
#: bounds are compared with room for rounding
_ROOM = 1 + 1e-9


def impute_nearest(
    df: DataFrame,
    columns: Sequence[str],
    neighbours: int = 5,
    donor_rows: int | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Fill every missing cell of ``columns``. A row that shares no column with a donor gets the mean."""
    columns = list(columns)
    donor_rows = DONOR_ROWS if donor_rows is None else donor_rows
    frame = df.withColumns({c: nan_to_null(F.col(c)) for c in columns})
    donors = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    facts = frame.agg(
        F.count(F.lit(1)).alias("all"),
        F.approx_count_distinct(F.xxhash64(*columns)).alias("kinds"),
        *[F.avg(c).alias(f"a{i}") for i, c in enumerate(columns)],
    ).first()
    means = [facts[f"a{i}"] for i in range(len(columns))]
    holes = _any_null(columns)
    if facts["kinds"] <= donor_rows:
        local = donors.limit(2 * donor_rows + 1).toPandas()
        if len(local) <= 2 * donor_rows:
            filled = frame.where(holes).mapInPandas(
                _broadcast_filler(local, columns, means, neighbours), frame.schema
            )
            return frame.where(~holes).unionByName(filled)
    fills = _cell_fills(frame, donors, columns, facts["kinds"], neighbours, cell_rows or CELL_ROWS)
    return _put_back(frame, fills, columns, means, facts["all"])


def _any_null(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


# --- the search kernel -----------------------------------------------------------------------


def _states(values: np.ndarray) -> np.ndarray:
    """Per row a word of one letter per column: 0 missing, 1 finite, 2 and 3 the infinities."""
    letters = np.where(np.isnan(values), b"0", np.where(values == np.inf, b"2", np.where(values == -np.inf, b"3", b"1")))
    return np.ascontiguousarray(letters).view(f"S{values.shape[1]}").ravel()


def _alike(states: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """The positions of every word, those of the most frequent first."""
    words, place = np.unique(states, return_inverse=True)
    split = np.split(np.argsort(place, kind="stable"), np.cumsum(np.bincount(place, minlength=len(words)))[:-1])
    return sorted(zip(words.tolist(), split), key=lambda pair: -len(pair[1]))


def _meet(asking: bytes, giving: bytes) -> tuple[list[int], list[int]]:
    """Columns a row and a donor share, and columns the donor can give; none if they are infinitely far apart."""
    shared, items = [], []
    for i, (a, g) in enumerate(zip(asking, giving)):
        if a == g == ord("1"):
            shared.append(i)
        elif a == ord("0") and g != ord("0"):
            items.append(i)
        elif a != g and ord("0") not in (a, g):
            return [], []
    return (shared, items) if shared else ([], [])


class _Tree:
    """Points in leaves of one size, so all rows go down level by level as arrays.

    Some points fill two places to even out the leaves; the second is blanked once the boxes are known.
    """

    def __init__(self, points: np.ndarray, scale: float):
        n, self.scale = len(points), scale
        depth = 0
        while n > _LEAF << depth:
            depth += 1
        places = -(-n // (1 << depth)) << depth
        self.leaf, doubled = places >> depth, (np.arange(places - n) * n) // max(1, places - n)
        order = np.concatenate([np.arange(n), doubled]).astype(np.int64)
        blank = np.arange(places) >= n
        self.cuts, self.boxes = [], []
        for level in range(depth + 1):
            nodes = points[order].reshape(1 << level, places >> level, -1)
            low, high = nodes.min(axis=1), nodes.max(axis=1)
            self.boxes.append((low, high))
            if level == depth:
                break
            axis, half = (high - low).argmax(axis=1), places >> level + 1
            along = np.take_along_axis(nodes, axis[:, None, None], axis=2)[:, :, 0]
            move = np.argpartition(along, half, axis=1)
            self.cuts.append((axis, np.take_along_axis(along, move[:, half : half + 1], axis=1)[:, 0]))
            move = (move + np.arange(1 << level)[:, None] * (places >> level)).ravel()
            order, blank = order[move], blank[move]
        self.spot = order.reshape(-1, self.leaf)
        self.columns = [np.where(blank, np.nan, points[order, i]).reshape(-1, self.leaf) for i in range(points.shape[1])]

    def _distances(self, rows: np.ndarray, at: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        squares = np.zeros((len(at), self.leaf))
        for i, column in enumerate(self.columns):
            gap = rows[at, i, None] - column[leaf]
            squares += gap * gap
        return np.sqrt(squares * self.scale)

    def search(self, rows: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, point and distance of every pair that may be among the k nearest and is within the limit of the row."""
        everyone, step = np.arange(len(rows)), max(1, _BLOCK // self.leaf)
        node = np.zeros(len(rows), dtype=np.int64)
        for axis, cut in self.cuts:
            node = 2 * node + (rows[everyone, axis[node]] >= cut[node])
        if self.leaf >= k:  # the k nearest of the own leaf
            limit = limit.copy()
            for start in range(0, len(rows), step):
                own = self._distances(rows, everyone[start : start + step], node[start : start + step])
                kth = np.partition(own, k - 1, axis=1)[:, k - 1]  # blanks come last
                limit[start : start + step] = np.fmin(limit[start : start + step], kth)
        square = limit * limit * (_ROOM / self.scale)
        at, node = everyone, np.zeros(len(rows), dtype=np.int64)
        for low, high in self.boxes[1:]:
            at, node = np.repeat(at, 2), np.repeat(2 * node, 2)
            node[1::2] += 1
            near = np.zeros(len(at))
            for i in range(rows.shape[1]):
                here = rows[at, i]
                gap = np.maximum(0.0, np.maximum(low[node, i] - here, here - high[node, i]))
                near += gap * gap
            keep = near <= square[at]
            at, node = at[keep], node[keep]
        parts = []
        for start in range(0, len(at), step):
            row, leaf = at[start : start + step], node[start : start + step]
            distance = self._distances(rows, row, leaf)
            pair, place = np.nonzero((distance <= limit[row, None]) & np.isfinite(distance))
            parts.append((row[pair], self.spot[leaf[pair], place], distance[pair, place]))
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (at, node, np.zeros(0))


def _take(at: np.ndarray, distance: np.ndarray, value: np.ndarray, copies: np.ndarray, k: int):
    """Of the candidates of every row the first k copies by distance and value, and whether a row has its k."""
    order = np.lexsort((value, distance, at))
    at, distance, value, copies = at[order], distance[order], value[order], copies[order]
    total = np.cumsum(copies) - copies
    first = np.flatnonzero(np.diff(at, prepend=-1))
    before = total - np.repeat(total[first], np.diff(first, append=len(at)))
    taken = np.minimum(copies, k - before)
    keep = taken > 0
    return at[keep], distance[keep], value[keep], taken[keep], (before + copies >= k)[keep]


class _Donors:
    """Donors by the columns they have, and the search for the k nearest among them."""

    def __init__(self, values: np.ndarray, copies: np.ndarray, k: int):
        self.values, self.copies, self.k = values, copies.astype(np.int64), k
        self.kinds = _alike(_states(values)) if len(values) else []

    def _trees(self, own: np.ndarray, shared: list[int], items: list[int]) -> list[tuple[_Tree, np.ndarray, list[int]]]:
        """Trees over the shared columns, with the donors in them and the columns they serve.

        Donors at one point are at one distance from everybody, so of them only the first k copies by value can count.
        """
        points, scale = self.values[np.ix_(own, shared)], self.values.shape[1] / len(shared)
        mixed = np.sort(points @ np.random.default_rng(0).normal(size=len(shared)))
        if (mixed[1:] != mixed[:-1]).all():
            return [(_Tree(points, scale), own, items)]
        out = []
        for j in items:
            value = self.values[own, j]
            order = np.lexsort((value, *points.T))
            same = np.cumsum(np.append(True, (points[order][1:] != points[order][:-1]).any(axis=1)))
            _, rank, _, _, _ = _take(same, np.arange(len(own)) * 1.0, value[order], self.copies[own[order]], self.k)
            kept = order[rank.astype(np.int64)]
            out.append((_Tree(points[kept], scale), own[kept], [j]))
        return out

    def search(self, rows: np.ndarray, bounds: np.ndarray):
        """Per group of rows alike: word, positions, and per missing column row, distance, value and copies.

        ``bounds`` has a distance per row and column within which the neighbours lie, and is lowered.
        """
        for word, members in _alike(_states(rows)):
            if b"0"[0] not in word:
                continue
            trees = {giving: self._trees(own, *meet) for giving, own in self.kinds if all(meet := _meet(word, giving))}
            for start in range(0, len(members), _TOGETHER):
                some = members[start : start + _TOGETHER]
                yield word, some, self._nearest(word, rows[some], some, bounds, trees)

    def _nearest(self, word: bytes, rows: np.ndarray, some: np.ndarray, bounds: np.ndarray, trees: dict) -> dict:
        found = {}
        for giving, forest in trees.items():
            shared, _ = _meet(word, giving)
            for tree, own, items in forest:
                at, spot, distance = tree.search(rows[:, shared], bounds[np.ix_(some, items)].max(axis=1), self.k)
                for j in items:
                    new = at, distance, self.values[own[spot], j], self.copies[own[spot]]
                    if j in found:
                        new = tuple(np.concatenate(pair) for pair in zip(found[j], new))
                    *found[j], full = _take(*new, self.k)
                    last, far = found[j][0][full], found[j][1][full]
                    bounds[some[last], j] = np.minimum(bounds[some[last], j], far)
        return found


def _means(rows: int, at: np.ndarray, value: np.ndarray, taken: np.ndarray) -> np.ndarray:
    count = np.bincount(at, taken, rows)
    with np.errstate(invalid="ignore"):
        return np.where(count > 0, np.bincount(at, value * taken, rows) / count, np.nan)


def _broadcast_filler(local: pd.DataFrame, columns: list[str], means: list[float | None], k: int):
    donors = _Donors(local[columns].to_numpy(dtype=float), local["copies"].to_numpy(), k)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[columns].to_numpy(dtype=float)
            out = np.where(np.isnan(rows), np.array([np.nan if m is None else m for m in means]), rows)
            for _, some, found in donors.search(rows, np.full(rows.shape, np.inf)):
                for j, (at, _, value, taken) in found.items():
                    mean = _means(len(some), at, value, taken)
                    out[some, j] = np.where(np.isnan(mean), out[some, j], mean)
            done = batch.copy()
            for j, c in enumerate(columns):
                done[c] = out[:, j]
            yield done

    return fill


# --- cells -----------------------------------------------------------------------------------


class _Cuts:
    """A tree of cuts whose ends are the cells. Rows without the column of a cut have an end or a tree of their own."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.axis, self.cut, self.next, self.cells = [], [], [], 0
        self._grow(sample, cells, frozenset())
        self.axis, self.cut, self.next = np.array(self.axis), np.array(self.cut), np.array(self.next)

    def _grow(self, sample: np.ndarray, cells: int, surely: frozenset) -> int:
        node, axis = len(self.axis), -1
        self.axis.append(-1), self.cut.append(0.0), self.next.append([node] * 3)
        if cells > 1 and len(sample):
            finite = np.where(np.isfinite(sample), sample, np.nan)
            some = np.flatnonzero((~np.isnan(finite)).sum(axis=0) > 1)
            spread = np.nanstd(finite[:, some], axis=0)
            if len(some) and spread.max() > 0:
                axis = int(some[spread.argmax()])
        if axis < 0:
            self.next[node] = [self.cells] * 3
            self.cells += 1
            return node
        along = sample[:, axis]
        held = np.sort(along[~np.isnan(along)])
        cut = float(held[(len(held) - 1) // 2])
        if cut == held[-1]:  # the upper side must not be empty
            cut = float(held[held < cut].max(initial=-np.inf))
        sides = [along <= cut, along > cut, np.isnan(along)]
        self.axis[node], self.cut[node] = axis, cut
        ways = []
        for number, side in enumerate(sides):
            if number == 2 and axis in surely:
                ways.append(ways[0])
            else:
                share = round(cells * side.sum() / len(sample))
                ways.append(self._grow(sample[side], max(1, share), surely if number == 2 else surely | {axis}))
        self.next[node] = ways
        return node

    def place(self, rows: np.ndarray, toss: np.ndarray | None = None) -> np.ndarray:
        """The cell of every row; with ``toss``, random numbers, a row without the column of a cut goes either way."""
        node, level = np.zeros(len(rows), dtype=np.int64), 0
        going = np.arange(len(rows))
        while len(going := going[self.axis[node[going]] >= 0]):
            here = node[going]
            value = rows[going, self.axis[here]]
            way = np.where(value <= self.cut[here], 0, np.where(np.isnan(value), 2, 1))
            if toss is not None:
                way = np.where(way == 2, toss[going] >> (level % 60) & 1, way)
            node[going], level = self.next[here, way], level + 1
        return self.next[node, 0]


class _Boxes:
    """Bounding boxes of the donors of every cell by the columns they have, and the cells rows still have to ask."""

    def __init__(self, table: pd.DataFrame, width: int, k: int):
        self.k, self.width = k, width
        self.cell, self.weight = table["cell"].to_numpy(), table["weight"].to_numpy()
        self.low = table[[f"lo{i}" for i in range(width)]].to_numpy(dtype=float)
        self.high = table[[f"hi{i}" for i in range(width)]].to_numpy(dtype=float)
        self.kinds = _alike(table["word"].to_numpy().astype("S")) if len(table) else []

    def _squares(self, rows: np.ndarray, boxes: np.ndarray, shared: list[int], far: bool = False) -> np.ndarray:
        out = np.zeros((len(rows), len(boxes)))
        for i in shared:
            below, above = self.low[boxes, i] - rows[:, i, None], rows[:, i, None] - self.high[boxes, i]
            gap = np.maximum(np.abs(below), np.abs(above)) if far else np.maximum(0.0, np.maximum(below, above))
            out += gap * gap
        return out * (self.width / len(shared))

    def farthest(self, word: bytes, rows: np.ndarray, item: int) -> np.ndarray:
        """A distance within which the boxes are sure to hold k donors that have the column."""
        meets = [(boxes, *_meet(word, giving)) for giving, boxes in self.kinds]
        meets = [(boxes, shared) for boxes, shared, items in meets if item in items]
        if not meets or not len(rows):
            return np.full(len(rows), np.inf)
        out, weight = [], np.concatenate([self.weight[boxes] for boxes, _ in meets])
        step = max(1, _BLOCK // len(weight))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            far = np.concatenate([self._squares(part, boxes, shared, True) for boxes, shared in meets], axis=1)
            order = np.argsort(far, axis=1)
            enough = np.cumsum(weight[order], axis=1) >= self.k
            nearest = np.take_along_axis(far, np.take_along_axis(order, enough.argmax(axis=1)[:, None], axis=1), axis=1)
            out.append(np.where(enough[:, -1], np.sqrt(nearest[:, 0]), np.inf))
        return np.concatenate(out)

    def further(self, word: bytes, rows: np.ndarray, bounds: np.ndarray, home: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of row and cell, without the own one, that can hold a nearer donor than the bounds of the row."""
        parts = [np.zeros((0, 2), dtype=np.int64)]
        for giving, boxes in self.kinds:
            shared, items = _meet(word, giving)
            boxes = boxes[self.cell[boxes] != home]
            if not items or not len(boxes):
                continue
            limit = bounds[:, items].max(axis=1)
            square, here = limit * limit * _ROOM, rows[:, shared]
            gap = np.maximum(0.0, np.maximum(self.low[np.ix_(boxes, shared)] - here.max(axis=0), here.min(axis=0) - self.high[np.ix_(boxes, shared)]))
            boxes = boxes[(gap * gap).sum(axis=1) * (self.width / len(shared)) <= square.max() * _ROOM]
            step = max(1, _BLOCK // len(rows))
            for start in range(0, len(boxes), step):
                some = boxes[start : start + step]
                at, box = np.nonzero(self._squares(rows, some, shared) <= square[:, None])
                parts.append(np.stack([at, self.cell[some[box]]], axis=1))
        pairs = np.unique(np.concatenate(parts), axis=0)
        return pairs[:, 0], pairs[:, 1]


def _cell_fills(
    frame: DataFrame, donors: DataFrame, columns: list[str], kinds: int, k: int, cell_rows: int
) -> DataFrame:
    """``columns..., copies, fill_0...`` for every distinct row with a missing cell."""
    width = len(columns)
    words = frame.select(F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])).distinct().count()
    if words > MAX_CELLS:
        raise ValueError(f"{words} combinations of present columns; impute fewer columns at once")
    cells = max(1, min(-(-kinds // cell_rows), MAX_CELLS // words))
    every = max(1, kinds // (cells * CUT_ROWS))
    sample = frame.where(F.pmod(F.xxhash64(*columns), F.lit(every)) == 0).select(*columns).distinct().toPandas()
    doubles = ", ".join(f"`{c}` double" for c in columns)
    placed = stage(
        donors.mapInPandas(
            _placer(_Cuts(sample.to_numpy(dtype=float), cells), columns),
            f"{doubles}, copies long, word string, cell int, home int",
        ).withColumn("row", F.monotonically_increasing_id()),
        "donors",
    )
    table = placed.groupBy("cell", "word").agg(
        F.sum(F.least("copies", F.lit(k))).alias("weight"),
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).toPandas()
    own = "row long, cell int, " + doubles
    sums = ", ".join(f"a{i} double" for i in range(width))
    candidate = "row long, item int, distance double, value double, taken long"
    asking = placed.where("home IS NOT NULL").select("row", F.col("home").alias("cell"), *columns)
    first = stage(
        _at_cells(placed, asking, columns).applyInPandas(
            _home_search(columns, k, _Boxes(table, width, k)),
            f"{own}, {sums}, item int, distance double, value double, taken long",
        ),
        "home",
    )
    settled = first.where("cell = -1").select("row", *[F.col(f"a{i}").alias(f"fill_{i}") for i in range(width)])
    visits = first.where("cell >= 0").select("row", "cell", *columns, *[f"a{i}" for i in range(width)])
    visited = _at_cells(placed, visits, columns).applyInPandas(_visit_search(columns, k), candidate)
    before = first.where("item IS NOT NULL").select("row", "item", "distance", "value", "taken")
    found = stage(before.unionByName(visited), "candidates")
    groups = -(-found.count() // MERGE_ROWS) or 1
    merged = (
        found.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
        .groupBy("part")
        .applyInPandas(_merger(width, k), "row long, " + ", ".join(f"fill_{i} double" for i in range(width)))
    )
    holding = placed.where("home IS NOT NULL").select("row", *columns, "copies")
    return holding.join(settled.unionByName(merged), "row", "left").drop("row")


def _placer(cuts: _Cuts, columns: list[str]):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = np.random.default_rng(0)
        for batch in batches:
            rows = batch[columns].to_numpy(dtype=float)
            home = cuts.place(rows, draw.integers(0, 1 << 60, len(rows)))
            yield batch.assign(
                word=_states(rows).astype("U"),
                cell=cuts.place(rows).astype("int32"),
                home=pd.array(np.where(np.isnan(rows).any(axis=1), home, -1), dtype="Int32"),
            ).assign(home=lambda b: b["home"].mask(b["home"] < 0))

    return place


def _at_cells(placed: DataFrame, asking: DataFrame, columns: list[str]):
    """Donors and asking rows by cell; many rows at one cell are dealt to several groups with the same donors."""
    crowd = asking.groupBy("cell").count().where(F.col("count") > VISIT_ROWS).collect()
    donors = placed.select("cell", *columns, "copies").withColumn("share", F.lit(0))
    asking = asking.withColumn("share", F.lit(0))
    if crowd:
        shares = placed.sparkSession.createDataFrame(
            [(r["cell"], -(-r["count"] // VISIT_ROWS)) for r in crowd], "cell int, shares int"
        )
        dealt = F.coalesce(F.col("shares"), F.lit(1))
        donors = donors.join(F.broadcast(shares), "cell", "left").withColumn("share", F.explode(F.sequence(F.lit(0), dealt - 1))).drop("shares")
        asking = asking.join(F.broadcast(shares), "cell", "left").withColumn("share", F.pmod(F.xxhash64("row"), dealt).cast("int")).drop("shares")
    return donors.groupBy("cell", "share").cogroup(asking.groupBy("cell", "share"))


def _home_search(columns: list[str], k: int, boxes: _Boxes):
    """Rows at the cell they lie in: ``cell`` is -1 and ``a`` the fills where no other cell can matter; else every
    cell to ask with the distances found as ``a``, and the candidates so far."""
    width = len(columns)
    names = ["row", "cell", *columns, *[f"a{i}" for i in range(width)], "item", "distance", "value", "taken"]

    def search(key: tuple, donors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        base, ids = rows[columns].to_numpy(dtype=float), rows["row"].to_numpy()
        bounds = np.full(base.shape, np.inf)
        given = _Donors(donors[columns].to_numpy(dtype=float), donors["copies"].to_numpy(), k)
        parts = []
        for word, some, found in given.search(base, bounds):
            here, limit = base[some], bounds[some]
            for j in np.flatnonzero(np.isnan(here[0])):
                open_ = np.flatnonzero(np.isinf(limit[:, j]))
                limit[open_, j] = boxes.farthest(word, here[open_], j)
            at, cell = boxes.further(word, here, limit, key[0])
            done = np.ones(len(some), dtype=bool)
            done[at] = False
            fills = np.full(here.shape, np.nan)
            for j, (who, distance, value, taken) in found.items():
                fills[:, j] = _means(len(some), who, value, taken)
                left = ~done[who]
                parts.append({"row": ids[some[who[left]]], "item": j, "distance": distance[left], "value": value[left], "taken": taken[left]})
            parts.append({"row": ids[some[done]], "cell": -1} | dict(zip(names[2 + width :], fills[done].T)))
            parts.append({"row": ids[some[at]], "cell": cell} | dict(zip(names[2:], np.concatenate([here, limit], axis=1)[at].T)))
        whole = [pd.DataFrame(p) for p in parts]
        out = pd.concat([p for p in whole if len(p)] or whole[:1] or [pd.DataFrame(columns=["row"])]).reindex(columns=names)
        return out.astype({"cell": "Int32", "item": "Int32", "taken": "Int64", "row": "int64"})

    return search


def _visit_search(columns: list[str], k: int):
    def search(donors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        base, ids = rows[columns].to_numpy(dtype=float), rows["row"].to_numpy()
        bounds = rows[[f"a{i}" for i in range(len(columns))]].to_numpy(dtype=float)
        given = _Donors(donors[columns].to_numpy(dtype=float), donors["copies"].to_numpy(), k)
        parts = [(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0))]
        for _, some, found in given.search(base, bounds):
            for j, (at, distance, value, taken) in found.items():
                parts.append((ids[some[at]], np.full(len(at), j), distance, value, taken))
        row, item, distance, value, taken = (np.concatenate(p) for p in zip(*parts))
        return pd.DataFrame({"row": row.astype("int64"), "item": item.astype("int32"), "distance": distance, "value": value, "taken": taken.astype("int64")})

    return search


def _merger(width: int, k: int):
    """The means over the candidates of all cells asked."""

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(found["row"].to_numpy(), return_inverse=True)
        out = {"row": ids}
        for j in range(width):
            mine = found["item"].to_numpy() == j
            who, _, value, taken, _ = _take(at[mine], *(found[c].to_numpy()[mine] for c in ("distance", "value", "taken")), k)
            out[f"fill_{j}"] = _means(len(ids), who, value, taken)
        return pd.DataFrame(out)

    return merge


def _put_back(
    frame: DataFrame, fills: DataFrame, columns: list[str], means: list[float | None], total: int
) -> DataFrame:
    """Join the fills to their rows; patterns held by many rows are broadcast, the rest is shuffled."""
    holes = _any_null(columns)
    fills = stage(fills, "fills")
    side = fills.select(
        *[F.col(c).alias(f"key_{i}") for i, c in enumerate(columns)],
        "copies",
        *[f"fill_{i}" for i in range(len(columns))],
    )
    is_hot = F.col("copies") >= F.lit(total * HOT_SHARE)
    hot, cold = F.broadcast(side.where(is_hot)), side.where(~is_hot)
    rows = frame.where(holes)

    def same(right: DataFrame) -> list[Column]:
        return [rows[c].eqNullSafe(right[f"key_{i}"]) for i, c in enumerate(columns)]

    def finish(joined: DataFrame) -> DataFrame:
        out = {}
        for i, c in enumerate(columns):
            mean = F.lit(None if means[i] is None else float(means[i])).cast("double")
            out[c] = F.coalesce(F.col(c), F.col(f"fill_{i}"), mean)
        return joined.withColumns(out).select(*frame.columns)

    from_hot = finish(rows.join(hot, same(hot), "inner"))
    from_cold = finish(rows.join(hot, same(hot), "left_anti").join(cold, same(cold), "left"))
    return frame.where(~holes).unionByName(from_hot).unionByName(from_cold)
