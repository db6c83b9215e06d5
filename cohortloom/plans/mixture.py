"""Synthetic tables by a mixture: rows come from components that have a normal distribution for each number and shares for each category.

The fit is expectation maximisation. Rows are coded and packed into blocks of bytes once, which every round reads as matrices. In a round every task sums, for its rows, the components' chances and what they weigh (counts,
sums and squares of known numbers, counts of categories); Spark adds these up, and the driver makes the next mixture from them. So a round is
one pass whatever the size of the table, and only the mixture itself comes to the driver. It starts from a bounded sample (SAMPLE_ROWS rows,
for the centres only).

Defined results: a missing number or category is an outcome of its own in each component; a column without values is always missing; a constant
column is constant; a category column with more than LISTED_VALUES values is drawn from all its shares, whatever the component; a
table without rows gives a mixture of which all rows are missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.operators import stats
from cohortloom.operators.sums import summed
from cohortloom.plans.synthesis import SYNTHESIZERS, _drawn, _shares, _uniform, to_normal
from cohortloom.sources import tables

#: Most values of a category column that components have shares of; rows that the first centres come from.
LISTED_VALUES, SAMPLE_ROWS = 256, 20_000
#: Bytes of a block of packed rows (small, as a batch to Python can hold 10,000 of them), and rows that are weighed at once.
BLOCK_BYTES, CHUNK_ROWS = 4096, 4096
#: Least variance, as a part of the column's.
LEAST_VARIANCE = 1e-4
COMPONENTS, ROUNDS, LEAST_GAIN = 8, 40, 1e-4


@dataclass
class Mixture:
    """numbers: name, type, mean, spread, least and largest value; categories: name, type, values; other: name, type and table of shares.

    weight: share of each component; mean, variance (of standard scores) and known (chance of not being missing): a row a component, a
    column a number; chances: for each category column a row a component, a column a value, and a last one for missing.
    """

    order: list[str]
    numbers: list[tuple]
    categories: list[tuple]
    other: list[tuple]
    weight: np.ndarray
    mean: np.ndarray
    variance: np.ndarray
    known: np.ndarray
    chances: list[np.ndarray]
    likelihood: list[float] = field(default_factory=list)

    def metadata(self) -> dict:
        kinds = {n[0]: {"kind": "number", "type": n[1]} for n in self.numbers} | {c[0]: {"kind": "category", "type": c[1]} for c in [*self.categories, *self.other]}
        return {c: kinds[c] for c in self.order}

    def component_means(self) -> np.ndarray:
        """In the columns' own units."""
        return self.mean * np.array([n[3] for n in self.numbers]) + np.array([n[2] for n in self.numbers])

    def save(self, spark: SparkSession, folder: str) -> None:
        for i, (_, _, shares, _) in enumerate(self.other):
            tables.write_parquet(shares, f"{folder}/shares_{i}")
        parts = {n: getattr(self, n).tolist() for n in ("weight", "mean", "variance", "known")}
        state = {"order": self.order, "numbers": self.numbers, "categories": self.categories, "other": [[n, t, missing] for n, t, _, missing in self.other], "chances": [c.tolist() for c in self.chances], "likelihood": self.likelihood}
        tables.write_json(spark, state | parts, f"{folder}/mixture.json")
        tables.write_json(spark, self.metadata(), f"{folder}/metadata.json")

    def log_chances(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The logarithm of weight times density, a row a component and a column a row. x: standard scores, NaN if missing, a row a number; codes: a row a category column."""
        out = np.repeat(np.log(np.maximum(self.weight, 1e-300))[:, None], x.shape[1], axis=1)
        for j, v in enumerate(x):
            density = v - self.mean[:, j, None]
            density *= np.sqrt(0.5 / self.variance[:, j, None])
            density *= density
            np.subtract((np.log(np.maximum(self.known[:, j], 1e-12)) - 0.5 * np.log(2 * np.pi * self.variance[:, j]))[:, None], density, out=density)
            missing = np.isnan(v)
            if missing.any():
                density[:, missing] = np.log(np.maximum(1 - self.known[:, j], 1e-12))[:, None]
            out += density
        for at, chance in zip(codes, self.chances):
            out += np.take(np.log(np.maximum(chance, 1e-12)), at, axis=1)
        return out

    def weighed(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Log-likelihood, and per component: rows, known cells, sums, squares, counts of values; one vector."""
        share = self.log_chances(x, codes)
        top = share.max(axis=0)
        share -= top
        np.exp(share, out=share)
        total = share.sum(axis=0)
        likelihood = float((np.log(total) + top).sum())
        share /= total
        there, v = (~np.isnan(x)).astype(float), np.nan_to_num(x)
        counts = [np.stack([np.bincount(at, w, c.shape[1]) for w in share]) for at, c in zip(codes, self.chances)]
        return np.concatenate([[likelihood], share.sum(axis=1), *[(share @ m.T).ravel() for m in (there, v, v * v)], *[c.ravel() for c in counts]])

    def next(self, sums: np.ndarray) -> Mixture:
        """The mixture that the sums of weighed() are likeliest for."""
        k, d = self.mean.shape
        sizes = [1, k, k * d, k * d, k * d, *[c.size for c in self.chances]]
        likelihood, rows, known, total, squares, *counts = np.split(sums, np.cumsum(sizes)[:-1])
        known, total, squares = (m.reshape(k, d) for m in (known, total, squares))
        n = max(rows.sum(), 1e-12)
        some = known > 1e-9
        mean = np.where(some, total / np.maximum(known, 1e-300), self.mean)
        variance = np.where(some, np.maximum(squares / np.maximum(known, 1e-300) - mean**2, LEAST_VARIANCE), self.variance)
        chances = [np.where(rows[:, None] > 1e-9, c.reshape(old.shape) / np.maximum(rows, 1e-300)[:, None], old) for c, old in zip(counts, self.chances)]
        return Mixture(self.order, self.numbers, self.categories, self.other, rows / n, mean, variance, known / np.maximum(rows, 1e-300)[:, None], chances, [*self.likelihood, float(likelihood[0] / n)])


def load_mixture(spark: SparkSession, folder: str) -> Mixture:
    s = tables.read_json(spark, f"{folder}/mixture.json")
    other = [(n, t, spark.read.parquet(f"{folder}/shares_{i}"), missing) for i, (n, t, missing) in enumerate(s["other"])]
    d = len(s["numbers"])
    return Mixture(s["order"], [tuple(n) for n in s["numbers"]], [tuple(c) for c in s["categories"]], other, np.array(s["weight"]), *[np.array(s[m], float).reshape(-1, d) for m in ("mean", "variance", "known")], [np.array(c) for c in s["chances"]], s["likelihood"])


def code(column: str, values: list) -> Column:
    """The place of a value in a list; one more for a missing one."""
    return F.when(F.col(column).isNull(), len(values)).otherwise(F.array_position(F.array(*map(F.lit, values)), F.col(column)) - 1).cast("int") if values else F.lit(0)


def _matrices(b: pa.RecordBatch, d: int, c: int) -> tuple[np.ndarray, np.ndarray]:
    """Coded rows as matrices, a row a column of theirs."""
    x = np.stack([b.column(f"x{j}").to_numpy(zero_copy_only=False).astype(float) for j in range(d)]) if d else np.zeros((0, b.num_rows))
    codes = np.stack([b.column(f"c{j}").to_numpy() for j in range(c)]) if c else np.zeros((0, b.num_rows), np.int32)
    return x, codes


def _packed(coded: DataFrame, d: int, c: int) -> DataFrame:
    """cells: some rows a block, each as its d standard scores and c codes, all doubles. Blocks of a table of few partitions are dealt out to all cores."""
    width = max(1, d + c)
    step = max(1, BLOCK_BYTES // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = np.zeros((b.num_rows, width))
            cells[:, : d + c] = np.concatenate(_matrices(b, d, c)).T
            yield pa.RecordBatch.from_arrays([pa.array([cells[i : i + step].tobytes() for i in range(0, b.num_rows, step)], pa.binary())], names=["cells"])

    packed, cores = coded.mapInArrow(run, "cells binary"), coded.sparkSession.sparkContext.defaultParallelism
    return packed.repartition(cores, F.xxhash64("cells")) if packed.rdd.getNumPartitions() < cores else packed


def _weighed(mixture: Mixture, b: pa.RecordBatch) -> np.ndarray:
    d, c = len(mixture.numbers), len(mixture.categories)
    column = b.column("cells").cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    cells = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(float).reshape(-1, max(1, d + c))
    parts = (np.ascontiguousarray(cells[i : i + CHUNK_ROWS].T) for i in range(0, len(cells), CHUNK_ROWS))
    return sum(mixture.weighed(m[:d], m[d : d + c].astype(np.int64)) for m in parts)


def fit_mixture(df: DataFrame, columns: list[str], components: int = COMPONENTS, rounds: int = ROUNDS, seed: int = 42) -> Mixture:
    types, numeric = dict(df.dtypes), set(stats.numeric_columns(df))
    names = [c for c in columns if c in numeric]
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in names}
    aggs = [f(x[c]).alias(f"{n}{i}") for i, c in enumerate(names) for n, f in (("m", F.avg), ("s", F.stddev_pop), ("l", F.min), ("h", F.max))]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs, *[F.approx_count_distinct(c, 0.02).alias(f"d_{c}") for c in columns if c not in numeric], *[F.count(c).alias(f"k_{c}") for c in columns if c not in numeric]).first()
    numbers = [(c, types[c], float(row[f"m{i}"] or 0), float(row[f"s{i}"] or 0) or 1.0, *(float(row[f"{e}{i}"] or 0) for e in "lh")) for i, c in enumerate(names)]
    categories, other = [], []
    for c in [c for c in columns if c not in numeric]:
        listed = sorted((r["value"] for r in stats.value_counts(df, c, LISTED_VALUES + 1).collect()), key=str) if row[f"d_{c}"] <= 2 * LISTED_VALUES else None
        if listed is not None and len(listed) <= LISTED_VALUES:
            categories.append((c, types[c], listed))
        else:
            other.append((c, types[c], _shares(df, c), 1 - row[f"k_{c}"] / row["n"]))
    coded = df.select(*[((x[n[0]] - n[2]) / n[3]).alias(f"x{j}") for j, n in enumerate(numbers)], *[code(c, values).alias(f"c{j}") for j, (c, _, values) in enumerate(categories)], F.xxhash64(F.lit(seed), *columns).alias("h"))
    mixture = _start(coded, columns, numbers, categories, other, components, seed, row["n"])
    size = 1 + len(mixture.weight) * (1 + 3 * len(numbers) + sum(len(v) + 1 for _, _, v in categories))
    packed = _packed(coded.drop("h"), len(numbers), len(categories)).persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(rounds if row["n"] else 0):
        mixture = mixture.next(summed(packed, size, mixture, _weighed))
        if len(mixture.likelihood) > 1 and mixture.likelihood[-1] - mixture.likelihood[-2] < LEAST_GAIN:
            break
    packed.unpersist()
    return mixture


def _start(coded: DataFrame, order: list[str], numbers: list, categories: list, other: list, components: int, seed: int, n: int) -> Mixture:
    """Each centre is a row of the sample, chosen with a chance that grows with its squared distance from the earlier ones."""
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    rows = coded.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).orderBy("h").limit(2 * SAMPLE_ROWS).toArrow().combine_chunks().to_batches()
    rng = np.random.default_rng(seed)
    x, codes = _matrices(rows[0], len(numbers), len(categories)) if rows else (np.full((len(numbers), 1), np.nan), np.full((len(categories), 1), 0))
    x, codes = x.T, codes.T
    seen = np.concatenate([np.nan_to_num(x), np.stack([codes[:, j] == v for j, (_, _, values) in enumerate(categories) for v in range(len(values) + 1)], axis=1)] if categories else [np.nan_to_num(x)], axis=1).astype(float)
    chosen = [int(rng.integers(len(seen)))]
    far = ((seen - seen[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < components and far.sum() > 1e-12:
        chosen.append(int(rng.choice(len(seen), p=far / far.sum())))
        far = np.minimum(far, ((seen - seen[chosen[-1]]) ** 2).sum(axis=1))
    k = len(chosen)
    blank = Mixture(order, numbers, categories, other, np.full(k, 1 / k), np.nan_to_num(x[chosen]), np.full((k, len(numbers)), 1.0), np.full((k, len(numbers)), 0.5), [np.full((k, len(v) + 1), 1 / (len(v) + 1)) for _, _, v in categories])
    nearest = np.stack([((seen - seen[c]) ** 2).sum(axis=1) for c in chosen], axis=1).argmin(axis=1)
    share = np.zeros((len(seen), k))
    share[np.arange(len(seen)), nearest] = 1
    there, v = ~np.isnan(x), np.nan_to_num(x)
    counts = [np.stack([np.bincount(codes[:, j], w, len(values) + 1) + 0.1 for w in share.T]) for j, (_, _, values) in enumerate(categories)]
    made = blank.next(np.concatenate([[0.0], share.sum(axis=0), *[(share.T @ m).ravel() for m in (there.astype(float), v, v * v)], *[c.ravel() for c in counts]]))
    made.variance, made.likelihood = np.maximum(made.variance, 0.05), []
    made.known = np.clip(made.known, 0.01, 0.99)
    return made


def sample_mixture(spark: SparkSession, mixture: Mixture, n: int, seed: int = 42) -> DataFrame:
    """n rows with an id; the same rows for the same seed whatever the partitioning. Numbers stay within those of the table."""
    kinds = {c[0]: c[1] for c in [*mixture.numbers, *mixture.categories]} | {c[0]: "double" for c in mixture.other}
    plain = Mixture(mixture.order, mixture.numbers, mixture.categories, [(c, t, None, missing) for c, t, _, missing in mixture.other], mixture.weight, mixture.mean, mixture.variance, mixture.known, mixture.chances)

    def rows(batches):
        import pandas as pd

        for b in batches:
            ids, out = b["id"].to_numpy(), {}
            which = np.minimum(np.searchsorted(np.cumsum(plain.weight), _uniform(ids, seed, 0)), len(plain.weight) - 1)
            for j, (c, kind, centre, spread, low, high) in enumerate(plain.numbers):
                z = to_normal(_uniform(ids, seed, 2 * j + 1))
                v = np.clip((plain.mean[which, j] + z * np.sqrt(plain.variance[which, j])) * spread + centre, low, high)
                v = np.rint(v).astype("int64").tolist() if kind in ("int", "bigint", "smallint", "tinyint") else v.tolist()
                out[c] = pd.Series(v, dtype=object).where(_uniform(ids, seed, 2 * j + 2) < plain.known[which, j], None)
            first = 2 * len(plain.numbers) + 1
            for j, (c, _, values) in enumerate(plain.categories):
                ends = np.cumsum(plain.chances[j], axis=1)
                at = (_uniform(ids, seed, first + j)[:, None] * ends[which, -1:] >= ends[which]).sum(axis=1)
                out[c] = pd.Series([[*values, None][min(a, len(values))] for a in at.tolist()], dtype=object)
            first += len(plain.categories)
            for j, (c, _, _, missing) in enumerate(plain.other):
                out[c] = pd.Series(_uniform(ids, seed, first + 2 * j), dtype=object).where(_uniform(ids, seed, first + 2 * j + 1) >= missing, None)
            yield pd.DataFrame({"id": ids} | {c: out[c] for c in plain.order})

    made = spark.range(0, n, 1, max(1, min(200, n // 50_000 + 1))).mapInPandas(rows, ", ".join(["id long", *[f"`{c}` {kinds[c]}" for c in mixture.order]]))
    for c, _, shares, _ in mixture.other:
        made = _drawn(made, c, shares)
    return made.select("id", *mixture.order)


#: The slot of TVAE is filled by the mixture: both draw a hidden state first, and the columns from it.
SYNTHESIZERS |= {"mixture": (fit_mixture, sample_mixture), "TVAE": (fit_mixture, sample_mixture)}
