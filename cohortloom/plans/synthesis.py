"""Synthetic tables by a Gaussian copula.

Fit: a grid of quantiles of each number (by a sketch, to a thousandth of the rows) and the shares of all categories, then the
correlation of normal scores, in one aggregation. Sample: correlated normal draws per row from seeded
column generators, turned into values by the grids. Nothing but the grids comes to the driver; the shares of a column with more than
LISTED_CATEGORIES categories stay a table, which rows are scored and drawn by in joins.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortloom.operators import stats, transforms
from cohortloom.sources import tables

GRID = 200
#: Most categories of a column whose shares are a list on the driver, and ranges of chance that a table of more is joined by.
LISTED_CATEGORIES, CHANCE_RANGES = 10_000, 1 << 16
_NORMAL = NormalDist()
_Z = np.linspace(-5, 5, 4001)
_P = np.array([_NORMAL.cdf(z) for z in _Z])


def to_normal(p: np.ndarray) -> np.ndarray:
    return np.interp(p, _P, _Z)


def from_normal(z: np.ndarray) -> np.ndarray:
    return np.interp(z, _Z, _P)


@dataclass
class Column_:
    name: str
    kind: str  # number or category
    type: str
    grid: np.ndarray  # quantiles, or upper ends of the categories' shares
    values: list = field(default_factory=list)
    null_share: float = 0.0
    shares: DataFrame | None = None  # value, low, high: the share of each category, end to end, if they are too many for a list
    distinct: int | None = None
    joined: bool = False  # shares is (or was, where a task needs no table) there

    def score(self, x: pd.Series) -> np.ndarray:
        """Normal scores; the middle of its share for a category."""
        if self.kind == "number":
            v = x.to_numpy(float)
            lo, hi = np.searchsorted(self.grid, v, "left"), np.searchsorted(self.grid, v, "right")
            return np.where(np.isnan(v), np.nan, to_normal(np.clip((lo + hi) / 2 / len(self.grid), 0.001, 0.999)))
        if self.joined:  # the middle of the share has been joined
            return to_normal(x.to_numpy(float))
        start = np.concatenate([[0], self.grid[:-1]])
        middle = dict(zip(self.values, (start + self.grid) / 2))
        return to_normal(np.array([middle.get(v, np.nan) for v in x], float))

    def value(self, p: np.ndarray) -> list:
        if self.kind == "number":
            out = np.interp(p, np.linspace(0, 1, len(self.grid)), self.grid)
            return np.rint(out).astype("int64").tolist() if self.type in ("int", "bigint", "smallint", "tinyint") else out.tolist()
        if self.joined:  # the value is joined afterwards
            return p.tolist()
        if not self.values:
            return [None] * len(p)
        return [self.values[k] for k in np.minimum(np.searchsorted(self.grid, p, "left"), len(self.values) - 1)]


@dataclass
class Copula:
    columns: list[Column_]
    factor: np.ndarray

    def metadata(self) -> dict:
        """Kind, type, share of NULL and number of different values of each column."""
        return {c.name: {"kind": c.kind, "type": c.type, "null_share": c.null_share, "distinct": c.distinct} for c in self.columns}

    def save(self, spark: SparkSession, folder: str) -> None:
        """Writes the model and its metadata as JSON, and tables of many categories as Parquet."""
        columns = [{"name": c.name, "kind": c.kind, "type": c.type, "grid": c.grid.tolist(), "values": c.values, "null_share": c.null_share, "distinct": c.distinct, "table": c.shares is not None} for c in self.columns]
        for i, c in enumerate(self.columns):
            if c.shares is not None:
                c.shares.write.mode("overwrite").parquet(f"{folder}/shares_{i}")
        tables.write_json(spark, {"columns": columns, "factor": self.factor.tolist()}, f"{folder}/copula.json")
        tables.write_json(spark, self.metadata(), f"{folder}/metadata.json")


def load_copula(spark: SparkSession, folder: str) -> Copula:
    model = json.loads("\n".join(r["value"] for r in spark.read.text(f"{folder}/copula.json", wholetext=True).collect()))
    columns = [Column_(c["name"], c["kind"], c["type"], np.array(c["grid"]), c["values"], c["null_share"], spark.read.parquet(f"{folder}/shares_{i}") if c["table"] else None, c["distinct"], c["table"]) for i, c in enumerate(model["columns"])]
    return Copula(columns, np.array(model["factor"]))


def _shares(df: DataFrame, column: str) -> DataFrame:
    """value, low, high: shares of all categories, end to end in the order of a hash; running sums go over its ranges."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("h", F.xxhash64("value")).withColumn("part", F.shiftright("h", 52))
    every = Window.orderBy("part")  # 4096 rows at most
    sums = counts.groupBy("part").agg(F.sum("n").alias("all"))
    sums = sums.select("part", (F.sum("all").over(every.rowsBetween(Window.unboundedPreceding, 0)) - F.col("all")).alias("before"), F.sum("all").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("whole"))
    end = F.sum("n").over(Window.partitionBy("part").orderBy("h", "value").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    return counts.join(F.broadcast(sums), "part").select("value", ((end - F.col("n")) / F.col("whole")).alias("low"), (end / F.col("whole")).alias("high"))


def fit_gaussian_copula(df: DataFrame, columns: list[str]) -> Copula:
    numeric, types = set(stats.numeric_columns(df)), dict(df.dtypes)
    numbers = [c for c in columns if c in numeric]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)], *[F.approx_count_distinct(c, 0.01).alias(f"d_{i}") for i, c in enumerate(columns)]).first()
    grids = dict(zip(numbers, df.select(*[F.col(c).cast("double") for c in numbers]).approxQuantile(numbers, [i / (GRID - 1) for i in range(GRID)], 0.001))) if numbers else {}
    made, scored = [], df.select(columns)
    for i, c in enumerate(columns):
        missing = 1 - counts[f"n_{i}"] / counts["n"] if counts["n"] else 0.0
        if c in numeric:
            made.append(Column_(c, "number", types[c], np.array(grids[c] or [0.0], float), [], missing, None, counts[f"d_{i}"]))
        elif counts[f"d_{i}"] <= LISTED_CATEGORIES:
            found = stats.value_counts(df, c, 2 * LISTED_CATEGORIES).collect()  # a sketch of the number is not off by half
            made.append(Column_(c, "category", types[c], np.cumsum([r["n"] for r in found]) / max(1, sum(r["n"] for r in found)), [r["value"] for r in found], missing, None, len(found)))
        else:
            shares = _shares(df, c)
            made.append(Column_(c, "category", types[c], np.zeros(0), [], missing, shares, counts[f"d_{i}"], True))
            middle = shares.select(F.col("value").alias(c), ((F.col("low") + F.col("high")) / 2).alias("__middle"))
            scored = scored.join(middle, c, "left").withColumn(c, F.col("__middle")).drop("__middle")

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({f"z{i}": c.score(b[c.name]) for i, c in enumerate(plain)})

    plain = [replace(c, shares=None) for c in made]  # a task needs no tables
    z = scored.mapInPandas(scores, ", ".join(f"z{i} double" for i in range(len(made))))
    z = z.select([F.when(~F.isnan(c), F.col(c)).alias(c) for c in z.columns])
    found = {(r["a"], r["b"]): r["r"] for r in stats.correlations(z).collect()} if len(made) > 1 else {}
    m = np.eye(len(made))
    for (a, b), r in found.items():
        m[int(a[1:]), int(b[1:])] = m[int(b[1:]), int(a[1:])] = 0.0 if r is None or np.isnan(r) else r
    low, vectors = np.linalg.eigh(m)
    m = vectors @ np.diag(np.maximum(low, 1e-6)) @ vectors.T
    scale = np.sqrt(np.diag(m))
    return Copula(made, np.linalg.cholesky(m / np.outer(scale, scale)))


def sample_gaussian_copula(spark: SparkSession, copula: Copula, n: int, seed: int = 42) -> DataFrame:
    """n rows with an id; the same rows for the same seed whatever the number of executors."""
    draws = spark.range(0, n, 1, max(1, min(200, n // 50_000 + 1)))
    columns, factor = [replace(c, shares=None) for c in copula.columns], copula.factor

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = b["id"].to_numpy()
            out = {"id": ids}
            d = len(columns)
            u = np.stack([_uniform(ids, seed, j) for j in range(2 * d)], axis=1)
            z = to_normal(u[:, :d]) @ factor.T
            for j, c in enumerate(columns):
                values = pd.Series(c.value(from_normal(z[:, j])), dtype=object)
                out[c.name] = values.where(u[:, d + j] >= c.null_share, None)
            yield pd.DataFrame(out)

    fields = ["id long"] + [f"`{c.name}` {'double' if c.shares is not None else c.type}" for c in copula.columns]
    made = draws.mapInPandas(rows, ", ".join(fields))
    for c in copula.columns:
        if c.shares is not None:
            made = _drawn(made, c.name, c.shares)
    return made.select("id", *[c.name for c in copula.columns])


def _drawn(rows: DataFrame, column: str, shares: DataFrame) -> DataFrame:
    """A column of chances becomes the category whose share holds each: a join by ranges of chance, which a share spans some of."""
    chance = F.col(column)
    at = lambda x: F.least(F.lit(CHANCE_RANGES - 1), F.floor(x * CHANCE_RANGES)).cast("int")
    spans = shares.select("value", "low", "high", F.explode(F.sequence(at(F.col("low")), at(F.col("high")))).alias("range"))
    keyed = rows.withColumn("__range", at(chance))
    inside = (F.col("__range") == F.col("range")) & (chance >= F.col("low")) & ((chance < F.col("high")) | ((F.col("high") >= 1) & (chance >= 1)))
    return keyed.join(spans, inside, "left").withColumn(column, F.col("value")).drop("__range", "value", "low", "high", "range")


def _uniform(ids: np.ndarray, seed: int, stream: int) -> np.ndarray:
    """A uniform number for each id by a hash, so that a row does not depend on its partition."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 1_000_003 + stream * 7_368_787 + 1)
        for a, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(a))) * np.uint64(m)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / (1 << 53)


#: Synthesizers by name: what fits a model (df, columns) and what draws from it (spark, model, n, seed). mixture.py and tree.py add
#: theirs; users can add others.
SYNTHESIZERS: dict[str, tuple[Callable, Callable]] = {"GC": (fit_gaussian_copula, sample_gaussian_copula)}


def synthesizer(kind: str) -> tuple[Callable, Callable]:
    from cohortloom.plans import mixture, tree  # noqa: F401  (they enter themselves)

    if kind not in SYNTHESIZERS:
        raise ValueError(f"no synthesizer {kind!r}; known: {sorted(SYNTHESIZERS)}")
    return SYNTHESIZERS[kind]


def synthesize(df: DataFrame, columns: list[str], n: int, kind: str = "GC", seed: int = 42) -> DataFrame:
    fit, sample = synthesizer(kind)
    return sample(df.sparkSession, fit(df, columns), n, seed)


def run(df: DataFrame, columns: list[str], n: int, folder: str, kind: str = "GC", seed: int = 42) -> DataFrame:
    """The synthesis stage: decimals as doubles and intervals as days; writes the model, its metadata and the rows, and gives the rows."""
    df = transforms.intervals_to_days(transforms.decimals_to_double(df))
    fit, sample = synthesizer(kind)
    model = fit(df, columns)
    if hasattr(model, "save"):
        model.save(df.sparkSession, f"{folder}/synth_{kind}")
    made = sample(df.sparkSession, model, n, seed)
    target = f"{folder}/synthdata_{kind}_{n}.parquet"
    tables.write_parquet(made, target)
    return df.sparkSession.read.parquet(target)
