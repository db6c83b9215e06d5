"""Near-duplicate embeddings by product quantisation (operator 10).

Equal vectors are counted as one with a weight. Coarse centroids give each vector an inverted list, that
of its nearest centroid, and its residual is coded by one codeword per subspace. Centroids within half the
radius of the cosine threshold of a larger list's are left out, so a narrow group is not split into many
lists. Every vector is a query. Two vectors of different lists lie on different sides of the plane halfway
between the centroids, so if they are linked, one of them is within half the radius of that plane: a vector
probes its own list and every list whose plane is that near, however many these are, and no pair is lost.
The distance from its residual to every code there comes from a table look-up. Each
code keeps its own coding error, so by the triangle inequality a look-up distance of at most the
radius plus that error never loses a pair within a probed list. What is left
is compared by exact cosine in double precision. So all links are found; spread-out vectors pay with more
probed lists (33 of 226 on average over 51,282 vectors of the check's large table).

Lists are put together to parts of bounded size, near ones to the same part, and a hot list is cut into several. A vector is
indexed in one part and asks each part that has a list it probes, once, whatever number of lists that is. In a part the
indexed rows come first and the queries stream past them; so many queries have their own copy of the part. A part gives sums
of links and spanning forests of its links, never all pairs. The quantiser is fitted on a bounded, hash-chosen sample; all rows
are indexed.

Defined results: vectors that are null, empty, zero or with null or non-finite components link with
nothing; vectors of different length never link; a null vec_id links with nothing and is kept; rows that repeat a vec_id are
vectors of their own with the same id; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrowtext import mix, tidy
from .components import connected_components
from .session import use_checkpoints

COSINE = 0.95
SUBSPACES, CODEWORDS = 8, 64
#: Rows, and numbers, that the quantiser is fitted on (in expectation); most lists.
SAMPLE_ROWS, SAMPLE_NUMBERS, MAX_LISTS = 20_000, 4 << 20, 4096
#: Fewest and most indexed rows of a part, and queries that share a copy of it.
PART_ROWS, PART_QUERIES = (256, 8192), 1 << 18
#: Numbers of a block of distances.
_BLOCK = 1 << 20
#: A cosine this near to the threshold is computed pair by pair, so that it does not depend on what is computed with it.
_MARGIN = 1e-9


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    c = distinct[np.sort(rng.choice(len(distinct), k, replace=False))].copy()
    for _ in range(rounds):
        own = _nearest(x, c, 1)[:, 0]
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The n nearest rows of c, nearest first."""
    out = np.empty((len(x), n), np.int64)
    for i in range(0, len(x), 2048):
        d = (c * c).sum(axis=1) - 2 * (x[i : i + 2048] @ c.T)
        near = np.argpartition(d, n - 1, axis=1)[:, :n] if n < len(c) else np.tile(np.arange(len(c)), (len(d), 1))
        out[i : i + 2048] = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
    return out


def _merged(sample: np.ndarray, c: np.ndarray, least: float) -> np.ndarray:
    """The centroids, without those within `least` of one that has more of the sample."""
    n = np.bincount(_nearest(sample, c, 1)[:, 0], minlength=len(c))
    open_, kept = np.ones(len(c), bool), []
    for i in np.argsort(-n, kind="stable").tolist():
        if open_[i]:
            kept.append(i)
            open_ &= ((c - c[i]) ** 2).sum(axis=1) > least**2
    return c[np.sort(kept)]


@dataclass
class Quantiser:
    centroids: np.ndarray
    books: list[np.ndarray]  # codewords of each subspace
    parts: list[slice]

    def probes(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest list of each row, number of lists it probes, these lists row by row).

        Of two vectors within the radius in different lists one at least probes the other's.
        """
        c, home, size, lists = self.centroids, [], [], []
        square = (c * c).sum(axis=1)
        for i in range(0, len(x), 512):
            d = square - 2 * (x[i : i + 512] @ c.T)
            own = d.argmin(axis=1)
            gap = np.sqrt(np.maximum(square[own][:, None] + square - 2 * (c[own] @ c.T), 0))
            # the distance to the plane is the difference of squared distances / (2 * gap)
            near = d - d[np.arange(len(d)), own][:, None] <= radius * gap + 1e-9
            home.append(own)
            size.append(near.sum(axis=1))
            lists.append(np.nonzero(near)[1])
        return np.concatenate(home), np.concatenate(size), np.concatenate(lists)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, coding error)."""
        codes = np.stack([_nearest(residual[:, p], b, 1)[:, 0] for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        error = np.sqrt(sum(((residual[:, p] - b[codes[:, m]]) ** 2).sum(axis=1) for m, (p, b) in enumerate(zip(self.parts, self.books))))
        return codes, error

    def tables(self, residual: np.ndarray) -> list[np.ndarray]:
        """Squared distance of each query's parts to each codeword."""
        return [((residual[:, p, None] - b.T[None]) ** 2).sum(axis=1) for p, b in zip(self.parts, self.books)]


def fit(sample: np.ndarray, lists: int, seed: int = 3, least: float = 0.0) -> Quantiser:
    rng = np.random.default_rng(seed)
    centroids = _merged(sample, _kmeans(sample, lists, rng), least)
    residual = sample - centroids[_nearest(sample, centroids, 1)[:, 0]]
    cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
    parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    return Quantiser(centroids, [_kmeans(residual[:, p], CODEWORDS, rng) for p in parts], parts)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Unit vectors in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id it is linked with in these links) wherever they differ."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(ids))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def _links(vectors: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(id, other, n): links of a spanning forest (id, other), and parts of the number of links (id, n)."""
    spark = vectors.sparkSession
    n = vectors.count()
    share = min(1.0, SAMPLE_ROWS / n, SAMPLE_NUMBERS / (n * dim))
    chance = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.where((chance < share) | F.lit(n * share < 50)).select("id", "vec").limit(2 * SAMPLE_ROWS).toArrow().sort_by("id") if share < 1 else vectors.select("id", "vec").toArrow().sort_by("id")
    radius = np.sqrt(2 - 2 * cosine)
    shared = spark.sparkContext.broadcast(fit(_matrix(sample["vec"], dim), int(min(MAX_LISTS, max(1, np.sqrt(n)))), least=radius / 2))
    vec_type = vectors.schema["vec"].dataType.simpleString()

    def assign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            q, x = shared.value, _matrix(b["vec"], dim)
            home, size, near = q.probes(x, radius)
            codes, error = q.encode(x - q.centroids[home])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(near, pa.int32()))
            yield pa.RecordBatch.from_arrays([b["id"], b["weight"], b["vec"], pa.array(home, pa.int32()), lists, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], names=["id", "weight", "vec", "list", "probes", "codes", "error"])

    coded = vectors.select("id", "weight", "vec").mapInArrow(tidy(assign), f"id long, weight long, vec {vec_type}, list int, probes array<int>, codes binary, error double").checkpoint()
    low, high = PART_ROWS
    members = {r["list"]: r["n"] for r in coded.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # MAX_LISTS rows at most
    askers = {r["list"]: r["n"] for r in coded.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = spark.sparkContext.broadcast(_parts(shared.value.centroids, members, askers, min(high, max(low, n // 12)), n))
    dealt = coded.mapInArrow(tidy(_dealer(parts)), f"part int, copy int, asks boolean, id long, weight long, vec {vec_type}, list int, probes array<int>, codes binary, error double")
    ordered = dealt.repartition("part", "copy").sortWithinPartitions("part", "copy", "asks")

    def compare(batches):
        key, part = None, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b["part"].to_numpy(), b["copy"].to_numpy(), b["asks"].to_numpy(zero_copy_only=False)], axis=1)
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]]))
            for i, j in zip(cuts[:-1], cuts[1:]):
                if key != tuple(keys[i, :2]):
                    if part:
                        yield part.counts()
                    key, part = tuple(keys[i, :2]), _Part(shared.value, dim, cosine)
                if keys[i, 2]:
                    yield from part.ask(b.slice(i, j - i))
                else:
                    part.index(b.slice(i, j - i))
        if part:
            yield part.counts()

    return ordered.mapInArrow(tidy(compare), "id long, other long, n long")


@dataclass
class Parts:
    """of_list[l]: the part of each block of list l; copies: copies of each part."""

    of_list: list[np.ndarray]
    copies: np.ndarray


def _parts(centroids: np.ndarray, members: dict[int, int], askers: dict[int, int], rows: int, n: int) -> Parts:
    """Lists, or blocks of them, in parts of about so many rows; near lists go to one part."""
    wanted = max(1, -(-n // rows))
    order = np.argsort(_nearest(centroids, _kmeans(centroids, wanted, np.random.default_rng(5)), 1)[:, 0], kind="stable")
    of_list, filled, asked = [np.zeros(0, np.int64)] * len(centroids), [0], [0]
    for i in order.tolist():
        size, own = members.get(i, 0), []
        blocks = max(1, -(-size // rows))
        for _ in range(blocks):
            if filled[-1] and filled[-1] + size // blocks > rows:
                filled.append(0)
                asked.append(0)
            filled[-1] += size // blocks
            asked[-1] += askers.get(i, 0)
            own.append(len(filled) - 1)
        of_list[i] = np.array(own)
    return Parts(of_list, np.array([max(1, -(-min(n, a) // PART_QUERIES)) for a in asked]))


def _dealer(shared):
    """Rows for the part a vector is indexed in (once for each copy), and for every part it asks."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            plan, home, probed = shared.value, b["list"].to_numpy(), b["probes"]
            salt = mix(b["id"].to_numpy().view(np.uint64))
            blocks = np.array([len(p) for p in plan.of_list])
            start = np.cumsum(blocks) - blocks
            flat = np.concatenate(plan.of_list)
            # which part of a list has the row
            own = flat[start[home] + (salt % blocks[home].astype(np.uint64)).astype(np.int64)]
            copies = plan.copies[own]
            ptr, lists = probed.offsets.to_numpy().astype(np.int64), probed.flatten().to_numpy()
            lists = lists[: ptr[-1] - ptr[0]]
            row = np.repeat(np.arange(b.num_rows), np.diff(ptr))
            many = blocks[lists]
            asked = np.repeat(row, many) * len(plan.copies) + flat[np.repeat(start[lists] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            asker, part = np.divmod(np.unique(asked), len(plan.copies))
            indexed = np.repeat(np.arange(b.num_rows), copies)
            copy = np.arange(len(indexed)) - np.repeat(np.cumsum(copies) - copies, copies)
            for take, parts, copy, asks in ((indexed, own[indexed], copy, False), (asker, part, (salt[asker] // np.uint64(7) % plan.copies[part].astype(np.uint64)).astype(np.int64), True)):
                for i in range(0, len(take), 8192):
                    rows = b.take(pa.array(take[i : i + 8192]))
                    head = [pa.array(parts[i : i + 8192], pa.int32()), pa.array(copy[i : i + 8192], pa.int32()), pa.array(np.full(rows.num_rows, asks))]
                    yield pa.RecordBatch.from_arrays([*head, *rows.columns], names=["part", "copy", "asks", *rows.schema.names])

    return run


class _Part:
    """The indexed rows of a part, and the links of the queries that stream past them."""

    def __init__(self, q: Quantiser, dim: int, cosine: float):
        self.q, self.dim, self.cosine, self.waiting, self.ids = q, dim, cosine, [], np.zeros(0, np.int64)

    def index(self, rows: pa.RecordBatch) -> None:
        self.waiting.append(rows)

    def _ready(self) -> None:
        rows = pa.Table.from_batches(self.waiting).combine_chunks().sort_by("list")
        self.waiting = []
        self.vectors, self.ids, self.weight = _matrix(rows["vec"], self.dim), rows["id"].to_numpy(), rows["weight"].to_numpy()
        self.codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.reach = ((np.sqrt(2 - 2 * self.cosine) + rows["error"].to_numpy()) ** 2 + 1e-5).astype(np.float32)  # look-ups are in single precision
        lists = rows["list"].to_numpy()
        self.lists, first = np.unique(lists, return_index=True)
        self.cuts = np.append(first, len(lists))
        self.probes = _probe_table(rows["probes"].combine_chunks(), len(self.q.centroids))
        self.links = np.zeros(len(self.ids), np.int64)

    def ask(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            self._ready()
        if not len(self.ids):
            return
        x, xid, xw, home = _matrix(rows["vec"], self.dim), rows["id"].to_numpy(), rows["weight"].to_numpy(), rows["list"].to_numpy()
        wants = _probe_table(rows["probes"], len(self.q.centroids))
        counts, edges = np.zeros(len(x), np.int64), []
        for here, lo, hi in zip(self.lists.tolist(), self.cuts[:-1], self.cuts[1:]):
            mine = np.flatnonzero(wants[:, here])
            step = max(16, _BLOCK // int(hi - lo))
            for i in range(0, len(mine), step):
                a, b = self._near(x, mine[i : i + step], here, lo, hi)
                keep = xid[a] != self.ids[b]
                a, b = a[keep], b[keep]
                counts += np.bincount(a, self.weight[b], len(x)).astype(np.int64)
                # the other side counts the link itself if it probes our list
                unseen = ~self.probes[b, home[a]]
                self.links += np.bincount(b[unseen], xw[a[unseen]], len(self.ids)).astype(np.int64)
                edges.append(np.stack(_forest(xid[a], self.ids[b])))
        if edges:
            some = counts > 0
            yield _found(xid[some], counts[some], *_forest(*np.concatenate(edges, axis=1)))

    def _near(self, x: np.ndarray, rows: np.ndarray, here: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, indexed row) of the linked pairs among some queries and one list."""
        part, codes, y, reach = x[rows], self.codes[lo:hi], self.vectors[lo:hi], self.reach[lo:hi]
        tables = [t.astype(np.float32) for t in self.q.tables(part - self.q.centroids[here])]
        # pairs that are too far in half of the subspaces need no more look-ups
        half = (len(tables) + 1) // 2
        distance = np.zeros((len(part), hi - lo), np.float32)
        for m in range(half):
            distance += tables[m][:, codes[:, m]]
        a, b = np.nonzero(distance <= reach)
        far = distance[a, b]
        for m in range(half, len(tables)):
            far += tables[m][a, codes[b, m]]
        near_enough = far <= reach[b]
        a, b = a[near_enough], b[near_enough]
        if len(a) * 8 > distance.size:
            cosines = (part @ y.T)[a, b]
            near, unsure = cosines >= self.cosine, np.flatnonzero(np.abs(cosines - self.cosine) <= _MARGIN)
        else:
            near, unsure = np.zeros(len(a), bool), np.arange(len(a))
        for k in range(0, len(unsure), 65536):
            at = unsure[k : k + 65536]
            near[at] = np.einsum("ij,ij->i", part[a[at]], y[b[at]]) >= self.cosine
        return rows[a[near]], lo + b[near]

    def counts(self) -> pa.RecordBatch:
        """What the queries found of the indexed rows' links."""
        if self.waiting or not len(self.ids):
            return _found(*[np.zeros(0, np.int64)] * 4)
        some = self.links > 0
        return _found(self.ids[some], self.links[some], np.zeros(0, np.int64), np.zeros(0, np.int64))


def _probe_table(probes: pa.Array, lists: int) -> np.ndarray:
    """Whether each row probes each list."""
    out = np.zeros((len(probes), lists), bool)
    ptr = probes.offsets.to_numpy().astype(np.int64)
    out[np.repeat(np.arange(len(probes)), np.diff(ptr)), probes.flatten().to_numpy()] = True
    return out


def _found(ids: np.ndarray, counts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
    """Numbers of links by id, and links of a forest."""
    edge = np.concatenate([np.zeros(len(ids), bool), np.ones(len(ends), bool)])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, ends])), pa.array(np.concatenate([np.zeros(len(ids), np.int64), others]), mask=~edge), pa.array(np.concatenate([counts, np.zeros(len(ends), np.int64)]), mask=edge)], names=["id", "other", "n"])


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = embeddings.sparkSession
    use_checkpoints(spark)
    vec = F.col("embedding").cast("array<double>")
    finite = F.coalesce(F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
    usable = F.when(finite & F.coalesce(F.exists(vec, lambda v: v != 0), F.lit(False)), vec)
    rows = embeddings.select(F.col("vec_id").cast("long"), usable.alias("vec")).withColumn("usable", F.col("vec").isNotNull() & F.col("vec_id").isNotNull())
    key = [F.xxhash64(F.lit(s), "vec").alias(k) for s, k in ((1, "k1"), (2, "k2"))]
    classes = rows.where("usable").select("vec_id", "vec", *key).groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec")).checkpoint()
    # one row for each class: its id is its key, as a vec_id can repeat
    classes = classes.withColumn("id", F.xxhash64("k1", "k2"))
    if embeddings.schema["embedding"].dataType.simpleString() == "array<float>":
        classes = classes.withColumn("vec", F.col("vec").cast("array<float>"))  # the same numbers in half the room
    dims = [r[0] for r in classes.select(F.size("vec")).distinct().collect()]
    parts = [_links(classes.where(F.size("vec") == d), d, cosine) for d in sorted(dims)]
    if parts:
        found = reduce(DataFrame.unionAll, parts).checkpoint()
    else:
        found = spark.createDataFrame([], "id long, other long, n long")
    counts = found.where("n is not null").groupBy("id").agg(F.sum("n").alias("n"))
    joined = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = classes.select("id", "k1", "k2", "rep", "weight").join(counts, "id", "left").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", F.when(F.col("usable"), key[0]).alias("k1"), F.when(F.col("usable"), key[1]).alias("k2")).join(named, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
