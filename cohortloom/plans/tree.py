"""Synthetic tables by a dependency tree: each column is drawn given its parent column's state, from a root down.

The fit gives every cell a state (a value, one of BINS ranges of a number, a range of the shares of a column with many values, or
missing, which is a state like any other and comes back as NULL). One pass counts the states of every pair of columns, for
pairs x states^2 groups at most, combined in the tasks; the mutual information of each pair is computed where the counts are. The driver gets one
number a pair, takes the tree of largest information, and then the counts of its edges.

Defined results: equal information goes to the earlier pair of columns; a table without rows gives NULLs; NaN is missing.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortloom.operators import stats
from cohortloom.plans.synthesis import SYNTHESIZERS, _drawn, _shares, _uniform
from cohortloom.sources import tables

#: Most values of a column that are states of their own; ranges of other columns.
LISTED_VALUES, BINS = 64, 32
_INTEGERS = ("int", "bigint", "smallint", "tinyint")


@dataclass
class State:
    """How a column's cells become states: its values, or the edges of its ranges (of chances, if shares is a table)."""

    name: str
    type: str
    values: list | None
    edges: list[float]
    shares: DataFrame | None = None
    drawn: bool = False  # shares is there, or was where a task needs no table

    @property
    def size(self) -> int:
        """The last state is 'missing'."""
        return (len(self.values) if self.values is not None else max(1, len(self.edges) - 1)) + 1

    def code(self) -> Column:
        c = F.col(self.name)
        if self.values is not None:
            found = F.array_position(F.array(*map(F.lit, self.values)), c) - 1 if self.values else F.lit(0)
        else:
            c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            inner = self.edges[1:-1]
            found = stats.cuts_below([inner], F.lit(0), c, True) if inner else F.lit(0)
        return F.when(c.isNull(), self.size - 1).otherwise(found).cast("int")

    def draw(self, state: np.ndarray, u: np.ndarray) -> pd.Series:
        """A value of each state; within a range by a uniform number."""
        missing = state == self.size - 1
        if self.values is not None:
            return pd.Series([None if m else self.values[s] for s, m in zip(state.tolist(), missing.tolist())], dtype=object)
        edges = np.array(self.edges if len(self.edges) > 1 else [0.0, 0.0])
        at = np.minimum(state, len(edges) - 2)
        v = edges[at] + u * (edges[at + 1] - edges[at])
        v = np.rint(v).astype("int64").tolist() if self.type in _INTEGERS else v.tolist()
        return pd.Series(v, dtype=object).where(~missing, None)


@dataclass
class Tree:
    """order: places of the columns from the root down; parent: of each place (-1: none); counts: rows of each parent's state, columns of its own."""

    states: list[State]
    order: list[int]
    parent: list[int]
    counts: list[np.ndarray]
    information: dict[tuple[str, str], float]

    def metadata(self) -> dict:
        return {s.name: {"kind": "number" if s.values is None and not s.drawn else "category", "type": s.type, "states": s.size, "parent": None if p < 0 else self.states[p].name} for s, p in zip(self.states, self.parent)}

    def save(self, spark: SparkSession, folder: str) -> None:
        for i, s in enumerate(self.states):
            if s.shares is not None:
                tables.write_parquet(s.shares, f"{folder}/shares_{i}")
        state = {"states": [[s.name, s.type, s.values, s.edges, s.drawn] for s in self.states], "order": self.order, "parent": self.parent, "counts": [c.tolist() for c in self.counts], "information": [[a, b, v] for (a, b), v in self.information.items()]}
        tables.write_json(spark, state, f"{folder}/tree.json")
        tables.write_json(spark, self.metadata(), f"{folder}/metadata.json")


def load_tree(spark: SparkSession, folder: str) -> Tree:
    s = tables.read_json(spark, f"{folder}/tree.json")
    states = [State(name, kind, values, edges, spark.read.parquet(f"{folder}/shares_{i}") if drawn else None, drawn) for i, (name, kind, values, edges, drawn) in enumerate(s["states"])]
    return Tree(states, s["order"], s["parent"], [np.array(c) for c in s["counts"]], {(a, b): v for a, b, v in s["information"]})


def pair_counts(coded: DataFrame, columns: list[str]) -> DataFrame:
    """pair, x, y, n: how many rows have each pair of values, for all pairs of columns (pair k is the k-th of combinations(columns, 2)), in one pass."""
    pairs = [F.struct(F.lit(k).alias("pair"), F.col(a).alias("x"), F.col(b).alias("y")) for k, (a, b) in enumerate(combinations(columns, 2))]
    return coded.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.pair", "p.x", "p.y").agg(F.count(F.lit(1)).alias("n"))


def mutual_information(counts: DataFrame) -> DataFrame:
    """pair, information (in nats, at least 0) from pair_counts()."""
    by = lambda *c: F.sum("n").over(Window.partitionBy("pair", *c))
    parts = counts.withColumns({"nx": by("x"), "ny": by("y"), "all": by()})
    part = F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("nx") * F.col("ny")))
    return parts.groupBy("pair").agg(F.greatest(F.lit(0.0), F.sum(part)).alias("information"))


def fit_tree(df: DataFrame, columns: list[str]) -> Tree:
    types, numeric = dict(df.dtypes), set(stats.numeric_columns(df))
    distinct = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    states, coded = [], df.select(columns)
    for i, c in enumerate(columns):
        if distinct[f"d{i}"] <= 2 * LISTED_VALUES:
            listed = sorted((r["value"] for r in stats.value_counts(df if types[c] not in ("float", "double") else df.where(~F.isnan(c)), c, LISTED_VALUES + 1).collect()), key=lambda v: (str(type(v)), v))
            if len(listed) <= LISTED_VALUES:
                states.append(State(c, types[c], listed, []))
                continue
        if c in numeric:
            edges = df.select(F.col(c).cast("double")).approxQuantile(c, [k / BINS for k in range(BINS + 1)], 0.001)
            states.append(State(c, types[c], None, sorted(set(edges))))
        else:
            shares = _shares(df, c)
            states.append(State(c, types[c], None, [k / BINS for k in range(BINS + 1)], shares, True))
            middle = shares.select(F.col("value").alias(c), ((F.col("low") + F.col("high")) / 2).alias("__middle"))
            coded = coded.join(middle, c, "left").withColumn(c, F.col("__middle")).drop("__middle")
    names = [f"s{i}" for i in range(len(columns))]
    coded = coded.select(*[s.code().alias(n) for s, n in zip(states, names)])
    if len(columns) == 1:
        return Tree(states, [0], [-1], [_filled(coded.groupBy(F.lit(0).alias("x"), F.col("s0").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect(), 1, states[0].size)], {})
    counts = pair_counts(coded, names).persist(StorageLevel.MEMORY_AND_DISK)
    pairs = list(combinations(range(len(columns)), 2))
    found = {pairs[r["pair"]]: r["information"] for r in mutual_information(counts).collect()}
    order, parent = [0], [-1] * len(columns)
    while len(order) < len(columns):
        a, b = max(((a, b) for a in order for b in range(len(columns)) if b not in order), key=lambda e: (found.get(tuple(sorted(e)), 0.0), -min(e), -max(e)))
        parent[b] = a
        order.append(b)
    edges = {pairs.index(tuple(sorted((p, c)))): (p, c) for c, p in enumerate(parent) if p >= 0}
    made = [np.zeros((1, s.size)) if parent[i] < 0 else np.zeros((states[parent[i]].size, s.size)) for i, s in enumerate(states)]
    for r in counts.where(F.col("pair").isin(list(edges))).collect():  # states^2 rows an edge
        p, c = edges[r["pair"]]
        x, y = (r["x"], r["y"]) if p < c else (r["y"], r["x"])
        made[c][x, y] = r["n"]
        if p == 0 and c == order[1]:
            made[0][0, x] += r["n"]
    counts.unpersist()
    return Tree(states, order, parent, made, {(columns[a], columns[b]): v for (a, b), v in found.items()})


def _filled(rows: list, height: int, width: int) -> np.ndarray:
    out = np.zeros((height, width))
    for r in rows:
        out[r["x"], r["y"]] = r["n"]
    return out


def sample_tree(spark: SparkSession, tree: Tree, n: int, seed: int = 42) -> DataFrame:
    """n rows with an id; the same rows for the same seed whatever the partitioning."""
    plain = [State(s.name, s.type, s.values, s.edges, None, s.drawn) for s in tree.states]
    order, parent, counts = tree.order, tree.parent, tree.counts

    def rows(batches):
        for b in batches:
            ids = b["id"].to_numpy()
            state: dict[int, np.ndarray] = {}
            for c in order:
                ends = np.cumsum(counts[c], axis=1)
                given = ends[np.zeros(len(ids), int) if parent[c] < 0 else state[parent[c]]]
                at = (_uniform(ids, seed, 2 * c)[:, None] * given[:, -1:] >= given).sum(axis=1)
                state[c] = np.where(given[:, -1] > 0, np.minimum(at, plain[c].size - 1), plain[c].size - 1)
            yield pd.DataFrame({"id": ids} | {s.name: s.draw(state[c], _uniform(ids, seed, 2 * c + 1)) for c, s in enumerate(plain)})

    fields = ["id long", *[f"`{s.name}` {'double' if s.drawn else s.type}" for s in plain]]
    made = spark.range(0, n, 1, max(1, min(200, n // 50_000 + 1))).mapInPandas(rows, ", ".join(fields))
    for s in tree.states:
        if s.drawn:
            made = _drawn(made, s.name, s.shares)
    return made.select("id", *[s.name for s in plain])


#: The slot of RTF is filled by the tree: both draw a row column by column, each given earlier ones, with missing cells as a value of their own.
SYNTHESIZERS |= {"tree": (fit_tree, sample_tree), "RTF": (fit_tree, sample_tree)}
