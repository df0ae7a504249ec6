"""Exact nearest neighbours by cells of a tree.

Rows with equal vectors are folded into one vector first, which keeps its k+1
smallest row keys: no list can need more of them, so a vector that a third of all
rows share costs as much as any other. A tree over a keyed sample of the right
vectors cuts the space into cells of bounded numbers of them. Each left vector is
searched in its own cell; the distance found there says which other cells may hold
a nearer row, and only left vectors near the edge of their cell go on to these. So right
vectors are not copied to other cells, only lists of left vectors that went on are merged, and the
answer is the same as by comparing all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import ident
from sparkrisk.session import materialize

# Right vectors of a cell: this many where they make few cells, never many more than a block.
VECTORS_PER_CELL = 1_024
FEW_CELLS = 64
LEFT_BLOCK = 32_768
RIGHT_BLOCK = 32_768
# Sampled vectors of a cell, and numbers of all of them beyond which a cell has fewer.
_SAMPLED = 64
_SAMPLE_NUMBERS = 8_000_000
_TILE = 2_000_000
# Rows of a box inside a block.
LEAF = 128
# Vectors shared by more rows than this, and than this part of the table, are joined
# by broadcast; there are at most _HOT_PARTS of them.
_HOT_ROWS = 100_000
_HOT_PARTS = 4_096
_SLACK = 1e-9


def vector(features: Sequence[str]) -> Column:
    """Features as one array; a missing value is an error, as distances need all of them."""
    return F.array(*[
        F.coalesce(ident(c).cast("double"),
                   F.raise_error(F.lit(f"missing value in {c!r}")).cast("double"))
        for c in features
    ])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sum of squared differences, added in feature order."""
    out = np.zeros((len(left), len(right)))
    for j in range(left.shape[1]):
        gap = left[:, j, None] - right[None, :, j]
        out += gap * gap
    return out


@dataclass(frozen=True)
class _Cells:
    """A tree of cuts: a row goes to the second child of ``children`` if its ``side`` lies above ``at``. A node
    without cut (``side`` -1) is a cell with its number in ``cell``; ``low`` and ``high`` are the corners of all cells."""

    side: np.ndarray
    at: np.ndarray
    children: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows := rows[self.side[node[rows]] >= 0]):
            here = node[rows]
            node[rows] = self.children[here, (x[rows, self.side[here]] > self.at[here]).astype(np.int64)]
        return self.cell[node]


def _cells(sample: np.ndarray, most: float) -> _Cells:
    """Cuts the sample at the middle of its widest side until no part has more than ``most`` rows."""
    width = sample.shape[1]
    side, at, children, cell, low, high = [-1], [0.0], [(0, 0)], [0], [], []
    waiting = [(0, np.arange(len(sample)), np.full(width, -np.inf), np.full(width, np.inf))]
    while waiting:
        node, rows, bottom, top = waiting.pop()
        cut = _halves(sample[rows]) if len(rows) > most else None
        if cut is None:
            cell[node] = len(low)
            low.append(bottom)
            high.append(top)
            continue
        side[node], at[node], below, above = cut
        children[node] = (len(side), len(side) + 1)
        ends = top.copy(), bottom.copy()
        ends[0][side[node]] = ends[1][side[node]] = at[node]
        waiting += [(len(side), rows[below], bottom, ends[0]), (len(side) + 1, rows[above], ends[1], top)]
        side, at, children, cell = side + [-1, -1], at + [0.0, 0.0], children + [(0, 0)] * 2, cell + [0, 0]
    return _Cells(np.array(side), np.array(at), np.array(children), np.array(cell), np.array(low), np.array(high))


def _halves(x: np.ndarray):
    """Widest side, place of the cut and rows on both sides of it; none if all rows are equal."""
    spread = x.max(axis=0) - x.min(axis=0)
    side = int(spread.argmax())
    if not spread[side] > 0:
        return None
    order = np.argsort(x[:, side], kind="stable")
    values = x[order, side]
    middle = values[len(values) // 2]
    cut = np.searchsorted(values, middle) or np.searchsorted(values, middle, side="right")  # equal values stay together
    return side, (values[cut - 1] + values[cut]) / 2, order[:cut], order[cut:]


def _gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances of one box from others."""
    gap = np.maximum(0, np.maximum(lows - high, low - highs))
    return (gap * gap).sum(axis=1)


def _find_cells(points: DataFrame, n_points: int, n_largest: int) -> _Cells:
    """Cells for ``n_points`` vectors, of which the largest group has ``n_largest``, from a keyed sample of them."""
    n_cells = max(math.ceil(1.5 * n_largest / RIGHT_BLOCK), min(FEW_CELLS, math.ceil(n_largest / VECTORS_PER_CELL)))
    width = max(1, len(points.select("vec").first()["vec"]))
    each = max(8, min(_SAMPLED, _SAMPLE_NUMBERS // (n_cells * width)))
    share = math.ceil(min(1.0, n_cells * each / n_points) * (1 << 30))
    drawn = points.where(F.pmod(F.xxhash64("grp", "vec"), F.lit(1 << 30)) < share).select("vec").toArrow()
    x = _matrix(drawn.column("vec").combine_chunks(), width) if drawn.num_rows else np.zeros((1, width))
    return _cells(x, len(x) / n_cells)


def _counts(df: DataFrame, cells: _Cells, groups: int) -> np.ndarray:
    """Rows of each group and cell; a task returns one row for each cell it meets."""
    width, shape = cells.low.shape[1], (groups, len(cells.low))

    def count(batches):
        total = np.zeros(shape, np.int64)
        for batch in batches:
            at = batch.column("grp").to_numpy() * shape[1] + cells.of(_matrix(batch.column("vec"), width))
            total += np.bincount(at, minlength=total.size).reshape(shape)
        grp, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grp, pa.int32()), pa.array(cell, pa.int32()), pa.array(total[grp, cell], pa.int64())], names=["grp", "cell", "n"])

    counted = df.select("grp", "vec").mapInArrow(count, "grp int, cell int, n long").groupBy("grp", "cell").agg(F.sum("n").alias("n"))
    out = np.zeros(shape, np.int64)
    for r in counted.collect():
        out[r["grp"], r["cell"]] = r["n"]
    return out


def _homes(cells: _Cells, counts: np.ndarray, wanted: int) -> np.ndarray:
    """Per group and cell the cell in which its left vectors are searched first: itself, or the nearest that has
    ``wanted`` right vectors, or else any; -1 in a group without right vectors."""
    out = np.tile(np.arange(counts.shape[1]), (len(counts), 1))
    for g, own in enumerate(counts):
        full = np.flatnonzero(own >= wanted)
        full = full if len(full) else np.flatnonzero(own)
        for c in np.setdiff1d(out[g], full):
            out[g, c] = full[_gaps(cells.low[c], cells.high[c], cells.low[full], cells.high[full]).argmin()] if len(full) else -1
    return out


@dataclass(frozen=True)
class _Blocks:
    """Blocks of right vectors: those of a cell begin at ``first`` and are ``many``, by group and cell; ``home`` as of :func:`_homes`."""

    cells: _Cells
    home: np.ndarray
    first: np.ndarray
    many: np.ndarray

    def of(self, grp: np.ndarray, x: np.ndarray, id: np.ndarray, left: bool) -> np.ndarray:
        cell = self.cells.of(x)
        if left:
            cell = self.home[grp, cell]
        return np.where(cell < 0, -1, self.first[grp, cell] + id % np.maximum(1, self.many[grp, cell]))

    def dealt(self, df: DataFrame, copies: np.ndarray, left: bool) -> DataFrame:
        """Adds ``block`` and ``part``: a left vector goes to one of the block's parts, a right one to all of them."""
        width, placed = self.cells.low.shape[1], "block" in df.columns

        def deal(batches):
            for batch in batches:
                grp, id = batch.column("grp").to_numpy(), batch.column("id").to_numpy()
                block = batch.column("block").to_numpy() if placed else self.of(grp, _matrix(batch.column("vec"), width), id, left)
                n = np.where(block < 0, 0, copies[grp, block])
                times = np.minimum(n, 1) if left else n
                at = np.repeat(np.arange(len(grp)), times)
                part = id[at] % n[at] if left else np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                taken = batch.select([c for c in batch.schema.names if c != "block"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(block[at], pa.int32()), pa.array(part, pa.int32())], names=[*taken.schema.names, "block", "part"])

        added = [T.StructField(n, T.IntegerType()) for n in ("block", "part")]
        return df.mapInArrow(deal, T.StructType([f for f in df.schema.fields if f.name != "block"] + added))


def _smallest(d2: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the k smallest entries per row, ties by column number."""
    k = min(k, d2.shape[1])
    if k == d2.shape[1]:
        return np.argsort(d2, axis=1, kind="stable")
    picked = np.argpartition(d2, k - 1, axis=1)[:, :k]
    edge = np.take_along_axis(d2, picked, axis=1).max(axis=1)
    tied = np.nonzero((d2 <= edge[:, None]).sum(axis=1) > k)[0]
    for i in tied:
        inside = np.nonzero(d2[i] <= edge[i])[0]
        picked[i] = inside[np.argsort(d2[i][inside], kind="stable")[:k]]
    return picked


def _leaves(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows halved along their widest side until few are left, and the boxes around them."""
    waiting, done = [np.arange(len(x))], []
    while waiting:
        rows = waiting.pop()
        part = x[rows]
        spread = part.max(axis=0) - part.min(axis=0)
        side = int(spread.argmax())
        if len(rows) <= LEAF or spread[side] == 0:
            done.append(rows)
            continue
        at = np.argsort(part[:, side], kind="stable")
        values = part[at, side]
        middle = len(rows) // 2
        cut = np.searchsorted(values, values[middle])  # equal values stay together where that is possible
        cut = cut or np.searchsorted(values, values[middle], side="right")
        waiting += [rows[at[:cut]], rows[at[cut:]]]
    return done, np.array([x[r].min(axis=0) for r in done]), np.array([x[r].max(axis=0) for r in done])


def _pairs(a: np.ndarray, b: np.ndarray, wanted: int, reach: np.ndarray):
    """Rows of ``a`` with the numbers and squared distances of their ``wanted`` nearest rows of ``b``, ties by number.

    Both are cut into small boxes. The nearest boxes of a left box give a distance within which each of its rows has
    ``wanted`` others; no box farther away than that, or than the squared distance ``reach``, is looked at.
    """
    leaves_b, low_b, high_b = _leaves(b)
    counts = np.array([len(r) for r in leaves_b])
    for rows, low, high in zip(*_leaves(a)):
        apart = _gaps(low, high, low_b, high_b)
        near = np.argsort(apart, kind="stable")
        first = int(np.searchsorted(np.cumsum(counts[near]), wanted)) + 1
        some = np.concatenate([leaves_b[k] for k in near[:first]])
        bound = reach[rows].max()
        if len(some) >= wanted:
            bound = min(bound, max(
                np.partition(squared_distances(a[rows[s:s + LEAF]], b[some]), wanted - 1, axis=1)[:, wanted - 1].max() for s in range(0, len(rows), LEAF)))
        within = np.flatnonzero(apart <= bound * (1 + _SLACK) + _SLACK)
        columns = np.sort(np.concatenate([leaves_b[k] for k in within])) if len(within) else np.zeros(0, np.int64)
        step = max(1, _TILE // max(1, len(columns)))
        for start in range(0, len(rows), step):
            d2 = squared_distances(a[rows[start:start + step]], b[columns])
            at = _smallest(d2, wanted)
            yield rows[start:start + step], columns[at], np.take_along_axis(d2, at, axis=1)


class _Members:
    """The rows behind the vectors of a block, in order of these."""

    def __init__(self, right: pa.Table, vectors: bool):
        lists = right["members"].combine_chunks()
        self.held = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.held) - self.held
        rows = lists.flatten()
        self.key, self.label = (pc.struct_field(rows, [k]) for k in (0, 1))
        self.vec = right["vec"].combine_chunks().take(pa.array(np.repeat(np.arange(len(lists)), self.held))) if vectors else None
        order = pc.sort_indices(
            pa.table({"key": self.key, "label": self.label}), [("key", "ascending"), ("label", "ascending")], null_placement="at_start").to_numpy()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))

    def nearest(self, at: np.ndarray, d2: np.ndarray, wanted: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row's nearest vectors the ``wanted`` first members by distance and key: row, number and squared distance."""
        if not at.shape[1]:  # no vector lies near enough
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        order = np.argsort(d2, axis=1, kind="stable")
        at, d2 = np.take_along_axis(at, order, axis=1), np.take_along_axis(d2, order, axis=1)
        full = np.cumsum(self.held[at], axis=1) >= wanted
        edge = np.full(len(at), np.inf)
        filled = full.any(axis=1)
        edge[filled] = d2[filled, full[filled].argmax(axis=1)]
        row, col = np.nonzero(d2 <= np.minimum(edge, reach)[:, None])
        times = self.held[at[row, col]]
        item = np.repeat(self.start[at[row, col]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        row, dist = np.repeat(row, times), np.repeat(d2[row, col], times)
        order = np.lexsort((self.rank[item], dist, row))
        row, item, dist = row[order], item[order], dist[order]
        some = np.arange(len(row)) - np.searchsorted(row, row) < wanted
        return row[some], item[some], dist[some]

    def lists(self, row: np.ndarray, item: np.ndarray, dist: np.ndarray, n: int) -> pa.ListArray:
        """Lists of members for ``n`` rows."""
        order = np.argsort(row, kind="stable")
        item = pa.array(item[order])
        names, parts = ["d2", "key", "label"], [pa.array(dist[order]), self.key.take(item), self.label.take(item)]
        if self.vec is not None:
            names, parts = [*names, "vec"], [*parts, self.vec.take(item)]
        return _listed(np.bincount(row, minlength=n), pa.StructArray.from_arrays(parts, names=names))


def _listed(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _sides(left: pa.Table, right: pa.Table, vectors: bool):
    """Vectors of both sides as matrices, the right ones by their first keys, and the rows behind these."""
    right = right.take(pc.sort_indices(right, [("first_key", "ascending")], null_placement="at_start"))
    some = left if left.num_rows else right
    width = len(some["vec"][0]) if some.num_rows else 0
    a, b = (_matrix(t["vec"].combine_chunks(), width) for t in (left, right))
    return a, b, _Members(right, vectors)


def _joined(parts: list, *kinds) -> list[np.ndarray]:
    return [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def _first_search(blocks: _Blocks, wanted: int, vectors: bool):
    """Searches left vectors in their own block: lists, and the other blocks that may hold nearer rows."""
    cells = blocks.cells

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, members = _sides(left, right, vectors)
        reach, found, beyond = np.full(len(a), np.inf), [], []
        if len(a):
            grp = left["grp"][0].as_py()
            own = left["block"][0].as_py()
            filled = np.flatnonzero(blocks.many[grp])
            for rows, at, d2 in _pairs(a, b, wanted, reach) if len(b) else [(np.arange(len(a)), np.zeros((len(a), 0), np.int64), np.zeros((len(a), 0)))]:
                row, item, dist = members.nearest(at, d2, wanted, reach[rows])
                found.append((rows[row], item, dist))
                last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) == wanted - 1)
                reach[rows[row[last]]] = dist[last]
                far = reach[rows] * (1 + _SLACK) + _SLACK
                x = a[rows]
                near = filled[_gaps(x.min(axis=0), x.max(axis=0), cells.low[filled], cells.high[filled]) <= far.max()]
                for c in near:
                    reached = rows[_gaps(cells.low[c], cells.high[c], x, x) <= far]
                    for block in range(blocks.first[grp, c], blocks.first[grp, c] + blocks.many[grp, c]):
                        if block != own:
                            beyond.append((reached, np.full(len(reached), block)))
        row, block = _joined(beyond, np.int64, np.int64)
        away = _listed(np.bincount(row, minlength=len(a)), pa.array(block[np.argsort(row, kind="stable")], pa.int32()))
        near = members.lists(*_joined(found, np.int64, np.int64, float), len(a))
        return pa.table({"grp": left["grp"], "id": left["id"], "vec": left["vec"], "n_rows": left["n_rows"],
                         "reach": pa.array(reach), "near": near, "away": away})

    return search


def _further_search(wanted: int, vectors: bool):
    """Searches left vectors in another block, for rows within the distance found so far."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, members = _sides(left, right, vectors)
        found = []
        if len(a) and len(b):
            reach = left["reach"].to_numpy()
            for rows, at, d2 in _pairs(a, b, wanted, reach):
                row, item, dist = members.nearest(at, d2, wanted, reach[rows])
                found.append((rows[row], item, dist))
        near = members.lists(*_joined(found, np.int64, np.int64, float), len(a))
        return pa.table({"id": left["id"], "near": near}).filter(pc.greater(pc.list_value_length(near), 0))

    return search


def _fold_equal_vectors(points: DataFrame, keep: int) -> DataFrame:
    """``(grp, vec, first_key, members)``: per vector its ``keep`` smallest keys with labels.

    The row-number filter is applied before the shuffle as well, so a vector shared
    by very many rows sends few of them from each task.
    """
    marked = points.withColumn("digest", _digest())
    return _first_of_each(marked, ["digest", "grp", "vec"], ["key"], keep, F.struct("key", "label"), "members").select(
        "grp", "vec", F.col("members")[0]["key"].alias("first_key"), "members"
    )


def _digest() -> Column:
    """A number that equal vectors of a group share. Sorts compare it first: numbers cost little, arrays are compared where it is equal."""
    return F.xxhash64("grp", "vec")


def _first_of_each(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, item: Column, output: str) -> DataFrame:
    """``(group.., output)``: array of the first ``n`` items of each group, in order.

    The list is gathered by a window over the rows left, so that the partitioning and
    the order of the row numbers serve it too.
    """
    place = Window.partitionBy(*group).orderBy(*order)
    everything = place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        df.withColumn("place", F.row_number().over(place)).where(F.col("place") <= n)
        .withColumn(output, F.collect_list(item).over(everything))
        .where(F.col("place") == 1).select(*group, output)
    )


def _numbered(df: DataFrame) -> DataFrame:
    """Gives every row of a table that is about to be written a number of its own."""
    return df.withColumn("id", F.monotonically_increasing_id())


def nearest(left: DataFrame, right: DataFrame, k: int, groups: int | None = None, vectors: bool = True) -> DataFrame:
    """For every row of ``left`` its k nearest rows of ``right``.

    Both tables have ``key, label, vec``. Returns ``key, label, vec, neighbours``; the
    array holds ``(d2, key, label, vec)`` by distance, then key; without ``vectors`` it lacks the vec. A row is not
    its own neighbour. With ``groups`` both tables also have ``grp`` (0 to ``groups`` - 1), which is kept, and
    neighbours are of the same group: many searches by the jobs of one. State on the driver is groups times cells.
    """
    if groups is None:
        alone = [t.withColumn("grp", F.lit(0)) for t in (left, right)]
        return nearest(*alone, k, 1, vectors).drop("grp")
    wanted = k + 1
    points = materialize(_numbered(_fold_equal_vectors(right, wanted)), "knn-points")
    asked = materialize(_numbered(left.groupBy("grp", "vec").agg(F.count(F.lit(1)).alias("n_rows"))), "knn-vectors")
    sizes = asked.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("n_rows"), F.max("n_rows").alias("top")).collect()
    n_points = {r["grp"]: r["count"] for r in points.groupBy("grp").count().collect()}
    kind = _list_type(right, vectors)
    if not sizes or not n_points:
        return _attach(left, asked.select("grp", "vec", "n_rows", F.lit(None).cast(kind).alias("near")), 0, 0, k)
    cells = _find_cells(points, sum(n_points.values()), max(n_points.values()))
    right_rows = _counts(points, cells, groups)
    many = -(-right_rows // RIGHT_BLOCK)
    blocks = _Blocks(cells, _homes(cells, right_rows, wanted), np.cumsum(many, axis=1) - many, many)
    found = materialize(_searched_first(asked, points, blocks, wanted, kind), "knn-first")
    lists = found.where(F.size("away") == 0).select("grp", "vec", "n_rows", "near")
    going = found.where(F.size("away") > 0)
    visits = {(r["grp"], r["block"]): r["count"] for r in going.select("grp", F.explode("away").alias("block")).groupBy("grp", "block").count().collect()}
    if visits:
        more = _searched_further(going, points, blocks, visits, wanted, kind).unionByName(going.select("id", "near"))
        best = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, wanted).alias("near")
        merged = going.select("id", "grp", "vec", "n_rows").join(more.groupBy("id").agg(best), "id")
        lists = lists.unionByName(merged.select("grp", "vec", "n_rows", "near"))
    return _attach(left, lists, sum(r["n_rows"] for r in sizes), max(r["top"] for r in sizes), k)


def _cogrouped(left: DataFrame, right: DataFrame, search, schema: T.StructType) -> DataFrame:
    block = ["grp", "block", "part"]
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(search, schema)


def _searched_first(asked: DataFrame, points: DataFrame, blocks: _Blocks, wanted: int, kind: T.ArrayType) -> DataFrame:
    """``(grp, id, vec, n_rows, reach, near, away)`` of all left vectors whose group has right vectors."""
    many = blocks.many
    left_rows = _counts(asked, blocks.cells, len(many))
    parts = np.zeros((len(many), int(many.sum(axis=1).max())), np.int64)
    for g, home in enumerate(blocks.home):
        here = np.bincount(home[home >= 0], left_rows[g][home >= 0], minlength=many.shape[1]).astype(np.int64)
        for c in np.flatnonzero(here):
            parts[g, blocks.first[g, c]:blocks.first[g, c] + many[g, c]] = -(-here[c] // (LEFT_BLOCK * many[g, c]))
    vectors = "vec" in kind.elementType.fieldNames()
    schema = T.StructType([*asked.select("grp", "id", "vec", "n_rows").schema.fields, T.StructField("reach", T.DoubleType()),
                           T.StructField("near", kind), T.StructField("away", T.ArrayType(T.IntegerType()))])
    return _cogrouped(blocks.dealt(asked, parts, True), blocks.dealt(points, parts, False), _first_search(blocks, wanted, vectors), schema)


def _searched_further(going: DataFrame, points: DataFrame, blocks: _Blocks, visits: dict, wanted: int, kind: T.ArrayType) -> DataFrame:
    """``(id, near)`` for each block that a left vector goes on to and finds rows in."""
    parts = np.zeros((len(blocks.many), int(blocks.many.sum(axis=1).max())), np.int64)
    for (g, block), n in visits.items():
        parts[g, block] = -(-n // LEFT_BLOCK)
    vectors = "vec" in kind.elementType.fieldNames()
    schema = T.StructType([going.schema["id"], T.StructField("near", kind)])
    visitors = going.select("grp", "id", "vec", "reach", F.explode("away").alias("block"))
    return _cogrouped(blocks.dealt(visitors, parts, True), blocks.dealt(points, parts, False), _further_search(wanted, vectors), schema)


def _list_type(right: DataFrame, vectors: bool) -> T.ArrayType:
    fields = [T.StructField("d2", T.DoubleType()), *(T.StructField(c, right.schema[c].dataType) for c in ("key", "label"))]
    return T.ArrayType(T.StructType(fields + ([T.StructField("vec", T.ArrayType(T.DoubleType()))] if vectors else [])))


def _attach(left: DataFrame, lists: DataFrame, n_rows: int, top: int, k: int) -> DataFrame:
    """Gives every left row the list of its vector, without the row itself.

    Vectors shared by more than 1/4096 of the rows (so at most 4096 of them) are
    joined by broadcast, all others by shuffle.
    """
    same = ["digest", "grp", "vec"]
    left, lists = left.withColumn("digest", _digest()), lists.withColumn("digest", _digest())
    hot_from = max(_HOT_ROWS, n_rows // _HOT_PARTS)
    if top > hot_from:
        hot = F.broadcast(lists.where(F.col("n_rows") > hot_from).select(*same, F.col("near").alias("hot")))
        cold = lists.where(F.col("n_rows") <= hot_from).select(*same, "near")
        marked = left.join(hot, same, "left")
        common = marked.where(F.col("hot").isNotNull()).withColumnRenamed("hot", "near")
        rest = marked.where(F.col("hot").isNull()).drop("hot").join(cold, same, "left")
        joined = common.unionByName(rest)
    else:
        joined = left.join(lists.select(*same, "near"), same, "left")
    others = F.filter("near", lambda n: n["key"] != F.col("key"))
    return joined.select("grp", "key", "label", "vec", F.slice(others, 1, k).alias("neighbours"))
