"""Exact nearest neighbours of a query set against a table, by cells with a bound.

Equal points of the table are one, with the ids of its first k rows, and equal queries are one. Points go to the cell of a
near pivot, and a large cell is cut into blocks. There are as many cells as the table has half blocks (up to a broadcast of
TREE_NUMBERS numbers), so pivots, which come from a bounded sample, are a tree of two levels: a point goes to its nearest top pivot and to the nearest
pivot below that. A query first searches a block of its own cell;
the distance of its k-th neighbour there bounds the rest: only cells that can reach into that distance (distance to the pivot
less the cell's radius, and distance to the box of the cell's points) are searched as well, but not that block again, so most queries are done by then. Queries and points meet by a shuffle: in each block the points come first and the
queries stream past them, and the best k of all blocks are merged. So the result is that of comparing every query with every
row, neither side passes through the driver, and a table of a few blocks is broadcast instead. A cell's blocks are copied for the queries
that come to it (counted before each search), left out of the second search if none do, and what a search needs is written first, so a task has one Python process.

Rows with a null coordinate are nobody's neighbours and have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortloom.sources import tables

#: Points of a block, queries that share a copy of it, and blocks of a table that is broadcast.
BLOCK_POINTS, BLOCK_QUERIES, WHOLE_BLOCKS = 1024, 1 << 18, 8
#: Rows of a batch that a task deals to blocks or gives back.
DEALT_ROWS = 8192
#: Most numbers of all pivots, and of the sample that they come from at least; numbers of a matrix of distances.
TREE_NUMBERS, SAMPLE_NUMBERS, MATRIX_NUMBERS = 1 << 22, 1 << 17, 1 << 17
_NONE = np.iinfo(np.int64).max


def nearest(queries: DataFrame, table: DataFrame, query_id: str, table_id: str, columns: list[str], k: int = 1) -> DataFrame:
    """query_id, table_id, distance, place (1..k): Euclidean, equal distances in the order of table_id."""
    names = [f"x{i}" for i in range(len(columns))]
    whole = lambda df, key, name: df.select(F.col(key).cast("long").alias(name), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, names)]).na.drop(subset=names)
    points, asked = _written(_distinct_points(whole(table, table_id, "t"), names, k), "points"), whole(queries, query_id, "q")
    asks = asked.select(*names).distinct()
    n = points.count()
    if n <= WHOLE_BLOCKS * BLOCK_POINTS:
        rows = points.toArrow()
        shared = points.sparkSession.sparkContext.broadcast((_points(rows, names), rows["ts"].combine_chunks()))
        found = asks.mapInArrow(_against_all(shared, names, k), _found_type(names))
    else:
        found = _by_cells(asks, points, names, n, k)
    found = asked.join(found, names).select("q", F.posexplode(F.arrays_zip("ts", "distances")).alias("at", "f"))  # in the order of distance and id
    return found.select(F.col("q").alias(query_id), F.col("f.ts").alias(table_id), F.col("f.distances").alias("distance"), (F.col("at") + 1).alias("place"))


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = tables.scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _distinct_points(points: DataFrame, names: list[str], k: int) -> DataFrame:
    """Each point once, with its k lowest ids; they are looked for within salts first, so that a frequent point is no hot key."""
    if k == 1:
        return points.groupBy(*names).agg(F.array(F.min("t")).alias("ts"))
    points = points.withColumn("salt", F.pmod(F.xxhash64("t"), F.lit(64)))
    for keys in ([*names, "salt"], names):
        points = points.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("t"))).where(F.col("place") <= k)
    return points.groupBy(*names).agg(F.sort_array(F.collect_list("t")).alias("ts"))  # k ids at most


def _points(rows: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([rows[x].to_numpy() if isinstance(rows, pa.Table) else rows.column(x).to_numpy(zero_copy_only=False) for x in names], axis=1)


def _found_type(names: list[str]) -> str:
    return ", ".join(f"{x} double" for x in names) + ", ts array<long>, distances array<double>"


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed column by column, so that a distance does not depend on what it is computed with."""
    d = _squares(x, y)
    return np.sqrt(d, out=d)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = np.zeros((len(x), len(y)))
    for c in range(x.shape[1]):
        gap = x[:, c, None] - y[None, :, c]
        gap *= gap
        d += gap
    return d


def _best(x: np.ndarray, y: np.ndarray, ids: pa.ListArray, k: int) -> tuple[pa.ListArray, pa.ListArray]:
    """The k nearest rows of each query among some points, each of which stands for several rows: their ids and distances."""
    step = max(1, MATRIX_NUMBERS // max(1, len(y)))
    if k == 1:
        first = ids.flatten().to_numpy()[ids.value_lengths().to_numpy().cumsum() - ids.value_lengths().to_numpy()]
        t, low = np.full(len(x), _NONE), np.full(len(x), np.nan)
        for i in range(0, len(x), step):
            d = _squares(x[i : i + step], y)
            row, point = np.nonzero(d <= d.min(axis=1, keepdims=True) * (1 + 1e-14))  # roots of these can be equal
            far = np.sqrt(d[row, point])
            order = np.lexsort((first[point], far, row))
            query, at = np.unique(row[order], return_index=True)
            t[i + query], low[i + query] = first[point[order[at]]], far[order[at]]
        at = pa.array(np.arange(len(x) + 1), pa.int32())
        return pa.ListArray.from_arrays(at, pa.array(t)), pa.ListArray.from_arrays(at, pa.array(low))
    ts, distances, ids = [], [], ids.to_pylist()
    for i in range(0, len(x), step):
        d = _distances(x[i : i + step], y)
        # all points that are as near as the k-th
        reach = np.partition(d, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1]
        for row, r in zip(d, reach):
            near = [(v, t) for p in np.flatnonzero(row <= r).tolist() for v in (row[p],) for t in ids[p]]
            near.sort()
            ts.append([t for _, t in near[:k]])
            distances.append([float(v) for v, _ in near[:k]])
    return pa.array(ts, pa.list_(pa.int64())), pa.array(distances, pa.list_(pa.float64()))


def _found(b: pa.RecordBatch, names: list[str], ts: pa.Array, distances: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[b.column(x) for x in names], ts, distances], names=[*names, "ts", "distances"])


def _against_all(shared, names: list[str], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, ids = shared.value
        for b in batches:
            if b.num_rows and len(y):
                yield _found(b, names, *_best(_points(b, names), y, ids, k))

    return run


@dataclass
class Cells:
    """pivots: one a cell, those of a top pivot one after another: first[t]:first[t + 1]."""

    pivots: np.ndarray
    tops: np.ndarray
    first: np.ndarray
    radius: np.ndarray  # of each cell; -1 if it has no points
    blocks: np.ndarray
    copies: np.ndarray  # of a cell's blocks in a search
    low: np.ndarray | None = None  # the box of each cell's points
    high: np.ndarray | None = None

    @staticmethod
    def grown(pivots: np.ndarray) -> Cells:
        """Some pivots are top pivots, about as many as each has below it."""
        tops = pivots[: int(np.ceil(np.sqrt(len(pivots))))]
        under = np.concatenate([_distances(pivots[i : i + 1024], tops).argmin(axis=1) for i in range(0, len(pivots), 1024)])
        order = np.argsort(under, kind="stable")
        ones = np.ones(len(pivots), np.int64)
        return Cells(pivots[order], tops, np.searchsorted(under[order], np.arange(len(tops) + 1)), np.zeros(len(pivots)), ones, ones)

    def filled(self, radius: np.ndarray, blocks: np.ndarray, copies: np.ndarray) -> Cells:
        return replace(self, radius=radius, blocks=blocks, copies=copies)

    @property
    def top_radius(self) -> np.ndarray:
        """How far the points below each top pivot can lie from it; -1 if it has none."""
        far = np.sqrt(((self.pivots - np.repeat(self.tops, np.diff(self.first), axis=0)) ** 2).sum(axis=1)) + self.radius
        far = np.where(self.radius >= 0, far * (1 + 1e-9), -1)
        return np.array([far[i:j].max(initial=-1) for i, j in zip(self.first[:-1], self.first[1:])])

    def own(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a near cell that has points, distance to its pivot)."""
        cell, distance = np.zeros(len(x), np.int64), np.zeros(len(x))
        empty = self.top_radius < 0
        step = max(1, MATRIX_NUMBERS // len(self.tops))
        for i in range(0, len(x), step):
            top = np.where(empty, np.inf, _distances(x[i : i + step], self.tops)).argmin(axis=1)
            for t in np.unique(top).tolist():
                rows, below = i + np.flatnonzero(top == t), slice(self.first[t], self.first[t + 1])
                d = np.where(self.radius[below] >= 0, _distances(x[rows], self.pivots[below]), np.inf)
                cell[rows], distance[rows] = d.argmin(axis=1) + self.first[t], d.min(axis=1)
        return cell, distance

    def box_distance(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Of each point to the box of a cell; computed as distances of points are, so rounding never puts it beyond a point inside."""
        d = np.zeros(len(x))
        for c in range(x.shape[1]):
            gap = np.maximum(np.maximum(self.low[cell, c] - x[:, c], x[:, c] - self.high[cell, c]), 0.0)
            d += gap * gap
        return np.sqrt(d)

    def within(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) where the cell can have a point as near as reach."""
        found, top_radius = [np.zeros((2, 0), np.int64)], self.top_radius
        step = max(1, MATRIX_NUMBERS // len(self.tops))
        near = lambda gap, r: gap <= r[:, None] + 1e-9 * (1 + np.abs(gap))
        for i in range(0, len(x), step):
            mine = reach[i : i + step]
            open_ = near(_distances(x[i : i + step], self.tops) - top_radius, mine) & (top_radius >= 0)
            for t in np.flatnonzero(open_.any(axis=0)).tolist():
                rows, below = np.flatnonzero(open_[:, t]), slice(self.first[t], self.first[t + 1])
                row, cell = np.nonzero(near(_distances(x[i + rows], self.pivots[below]) - self.radius[below], mine[rows]) & (self.radius[below] >= 0))
                row, cell = rows[row], cell + self.first[t]
                keep = ~(self.box_distance(x[i + row], cell) > mine[row])
                found.append(np.stack([row[keep] + i, cell[keep]]))
        return tuple(np.concatenate(found, axis=1))


def _by_cells(asks: DataFrame, points: DataFrame, names: list[str], n: int, k: int) -> DataFrame:
    spark, d = points.sparkSession, len(names)
    wanted = max(1, min(-(-2 * n // BLOCK_POINTS), TREE_NUMBERS // d))
    rows = max(SAMPLE_NUMBERS // d, 2 * wanted)
    chance = F.pmod(F.xxhash64(F.lit(3), *names), F.lit(1 << 30)) / float(1 << 30)
    sample = np.unique(_points(points.where(chance < min(1.0, rows / n)).select(*names).limit(2 * rows).toArrow(), names), axis=0)
    tree = Cells.grown(sample[np.random.default_rng(1).permutation(len(sample))[:wanted]])
    located = points.mapInArrow(_located(spark.sparkContext.broadcast(tree), names), ", ".join(f"{x} double" for x in names) + ", ts array<long>, cell int, gap double")
    located = _written(located, "located")
    ends = [f(x).alias(f"{e}{x}") for x in names for e, f in (("low_", F.min), ("high_", F.max))]
    by_cell = located.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius"), *ends).toArrow()  # a row a cell
    sizes, radius, at = np.zeros(len(tree.pivots), np.int64), np.full(len(tree.pivots), -1.0), by_cell["cell"].to_numpy()
    sizes[at], radius[at] = by_cell["n"].to_numpy(), by_cell["radius"].to_numpy()
    low, high = np.zeros((2, *tree.pivots.shape))
    low[at], high[at] = (_points(by_cell, [f"{e}{x}" for x in names]) for e in ("low_", "high_"))
    kept = replace(tree.filled(radius, np.maximum(1, -(-sizes // BLOCK_POINTS)), np.ones(len(sizes), np.int64)), low=low, high=high)
    filled = spark.sparkContext.broadcast(kept)
    fields = "cell int, block int, copy int, asks boolean, " + ", ".join(f"{x} double" for x in names) + ", ts array<long>"
    order = ["cell", "block", "copy", "asks"]

    def come(queries: DataFrame) -> np.ndarray:
        """Copies of each cell's blocks for the queries that come to it; queries: cell and n."""
        found, copies = queries.groupBy("cell").agg(F.sum("n").alias("n")).toArrow(), np.zeros(len(sizes), np.int64)
        copies[found["cell"].to_numpy()] = -(-found["n"].to_numpy() // BLOCK_QUERIES)
        return copies

    def search(queries: DataFrame, deal, cells: Cells) -> DataFrame:
        shared = spark.sparkContext.broadcast(cells)
        dealt = located.mapInArrow(_deal_points(shared, names), fields).unionByName(queries.mapInArrow(deal(shared), fields))
        return dealt.repartition(*order[:3]).sortWithinPartitions(*order).mapInArrow(_search(names, k), "cell int, block int, " + _found_type(names))

    asks = _written(asks.mapInArrow(_located(filled, names), ", ".join(f"{x} double" for x in names) + ", cell int, gap double"), "asks")
    first = come(asks.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))
    near = _written(search(asks, lambda shared: _deal_first(shared, names), kept.filled(radius, kept.blocks, np.maximum(1, first))), "near")
    copies = come(near.mapInArrow(_reached(filled, names, k), "cell int, n long"))
    # the best k of all blocks
    found = near.drop("cell", "block")
    if copies.any():
        found = found.unionByName(search(near, lambda shared: _deal_rest(shared, names, k), replace(kept, copies=copies)).drop("cell", "block"))
    if k == 1:
        pairs = found.select(*names, F.get("distances", F.lit(0)).alias("distance"), F.get("ts", F.lit(0)).alias("t")).where("t is not null")
        pairs = pairs.groupBy(*names).agg(F.min(F.struct("distance", "t")).alias("f"))
        return pairs.select(*names, F.array("f.t").alias("ts"), F.array("f.distance").alias("distances"))
    pairs = found.select(*names, F.arrays_zip("distances", "ts").alias("f")).groupBy(*names).agg(F.sort_array(F.flatten(F.collect_list("f"))).alias("f"))
    return pairs.select(*names, F.slice(F.col("f.ts"), 1, k).alias("ts"), F.slice(F.col("f.distances"), 1, k).alias("distances"))


def _located(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, gap = shared.value.own(_points(b, names))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(gap)], names=[*b.schema.names, "cell", "gap"])

    return run


def _dealt(b: pa.RecordBatch, names: list[str], take: np.ndarray, cell: np.ndarray, block: np.ndarray, copy: np.ndarray, asks: bool) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(take), DEALT_ROWS):
        at = slice(i, i + DEALT_ROWS)
        rows = b.take(pa.array(take[at]))
        # a query's list is empty, not null: Spark measures a batch after every row, and that passes over all nulls at the end of a list column again
        ts = pa.ListArray.from_arrays(pa.array(np.zeros(rows.num_rows + 1), pa.int32()), pa.array([], pa.int64())) if asks else rows.column("ts")
        head = [pa.array(cell[at], pa.int32()), pa.array(block[at], pa.int32()), pa.array(copy[at], pa.int32()), pa.array(np.full(rows.num_rows, asks))]
        yield pa.RecordBatch.from_arrays([*head, *[rows.column(x) for x in names], ts], names=["cell", "block", "copy", "asks", *names, "ts"])


def _salt(x: np.ndarray) -> np.ndarray:
    """A hash of each point."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(x), np.uint64)
        for c in range(x.shape[1]):
            h = (h ^ (x[:, c] + 0.0).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def _deal_points(shared, names: list[str]):
    """Every point to its block, once for each copy of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for b in batches:
            cell = b.column("cell").to_numpy().astype(np.int64)
            block = (_salt(_points(b, names)) % cells.blocks[cell].astype(np.uint64)).astype(np.int64)
            copies = cells.copies[cell]
            take = np.repeat(np.arange(b.num_rows), copies)
            yield from _dealt(b, names, take, cell[take], block[take], np.arange(len(take)) - np.repeat(np.cumsum(copies) - copies, copies), False)

    return run


def _deal_first(shared, names: list[str]):
    """Every query to a block of its own cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for b in batches:
            x = _points(b, names)
            cell, salt = b.column("cell").to_numpy().astype(np.int64), _salt(x)
            yield from _dealt(b, names, np.arange(len(x)), cell, (salt % cells.blocks[cell].astype(np.uint64)).astype(np.int64), (salt // np.uint64(5) % cells.copies[cell].astype(np.uint64)).astype(np.int64), True)

    return run


def _within(cells: Cells, b: pa.RecordBatch, names: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The queries of a batch, and (query, cell, block) where the k-th neighbour so far does not rule the cell out and the block is not searched yet."""
    x, found = _points(b, names), b.column("distances")
    many = found.value_lengths().to_numpy()
    reach = np.full(len(x), np.inf)
    reach[many >= k] = found.flatten().to_numpy()[(np.cumsum(many) - many + k - 1)[many >= k]]
    row, cell = cells.within(x, reach)
    blocks = cells.blocks[cell]
    row, cell = np.repeat(row, blocks), np.repeat(cell, blocks)
    block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    own, place = b.column("cell").to_numpy(), b.column("block").to_numpy()
    rest = (cell != own[row]) | (block != place[row])
    return x, row[rest], cell[rest], block[rest]


def _reached(shared, names: list[str], k: int):
    """How many queries go to each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, DEALT_ROWS):
                _, row, cell, _ = _within(shared.value, b.slice(i, DEALT_ROWS), names, k)
                once = np.ones(len(row), bool)  # a cell's blocks follow one another
                once[1:] = (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])
                cell, n = np.unique(cell[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n, pa.int64())], names=["cell", "n"])

    return run


def _deal_rest(shared, names: list[str], k: int):
    """Every query to all other blocks of the cells that its k-th neighbour so far does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, DEALT_ROWS):
                b = whole.slice(i, DEALT_ROWS)
                x, take, cell, block = _within(cells, b, names, k)
                yield from _dealt(b, names, take, cell, block, (_salt(x)[take] // np.uint64(5) % cells.copies[cell].astype(np.uint64)).astype(np.int64), True)

    return run


def _searched(b: pa.RecordBatch, names: list[str], ts: pa.Array, distances: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column("cell"), b.column("block"), *_found(b, names, ts, distances).columns], names=["cell", "block", *names, "ts", "distances"])


def _search(names: list[str], k: int):
    """Rows in the order of their block, its points first: what each query finds there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, y, ids, waiting = None, np.zeros((0, len(names))), None, []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "block", "copy", "asks")], axis=1)
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]]))
            for i, j in zip(cuts[:-1], cuts[1:]):
                rows = b.slice(i, j - i)
                if key != tuple(keys[i, :3]):
                    key, y, ids, waiting = tuple(keys[i, :3]), np.zeros((0, len(names))), None, []
                if not keys[i, 3]:
                    waiting.append(rows.select([*names, "ts"]))
                    continue
                if waiting:
                    points, waiting = pa.Table.from_batches(waiting).combine_chunks(), []
                    y, ids = _points(points, names), points["ts"].combine_chunks()
                if len(y):
                    yield _searched(rows, names, *_best(_points(rows, names), y, ids, k))
                elif key is not None:  # an empty block: nothing found, and so nothing ruled out
                    yield _searched(rows, names, pa.array([[]] * rows.num_rows, pa.list_(pa.int64())), pa.array([[]] * rows.num_rows, pa.list_(pa.float64())))

    return run
