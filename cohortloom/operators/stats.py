"""Column statistics as long tables, each from one pass where one pass is enough."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType

#: Ranges that a cumulative distribution is cut into, at least, and rows of a range, so that no task sorts a whole column.
RANGES, RANGE_ROWS = 64, 2_000_000
#: Rows that one task may rank or hold; share of the rows that a quantile is bracketed by on both sides.
EXACT_ROWS, SKETCH_ERROR = 1_000_000, 0.002
#: Most values of a sample whose KS p-value is exact.
EXACT_KS = 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("int", "bigint", "smallint", "tinyint", "float", "double") or t.startswith("decimal")]


def categorical_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("string", "boolean")]


def _long(row: DataFrame, columns: list[str], fields: dict[str, str]) -> DataFrame:
    """One row of {field}_{i} as a row per column."""
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}_{i}").cast(t).alias(f) for f, t in fields.items()]) for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def null_profile(df: DataFrame) -> DataFrame:
    """column, n_null, pct_null."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"k_{i}") for i, c in enumerate(df.columns)])
    missing = lambda i: F.col("n") - F.col(f"k_{i}")
    row = row.select(*[x for i in range(len(df.columns)) for x in (missing(i).alias(f"n_null_{i}"), F.when(F.col("n") > 0, 100 * missing(i) / F.col("n")).alias(f"pct_null_{i}"))])
    return _long(row, df.columns, {"n_null": "long", "pct_null": "double"})


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], rows: int | None = None) -> dict[str, list[float | None]]:
    """The exact quantiles of each column, as percentile() gives them; columns x probabilities numbers come to the driver.

    percentile() holds every distinct value of a column in one task. So from EXACT_ROWS rows on, each quantile is bracketed by a
    sketch, and what lies in the brackets is bracketed again until it is few rows; these are ranked. rows: their number, if known.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(columns)])
    if (df.count() if rows is None else rows) <= EXACT_ROWS:
        row = values.agg(*[F.percentile(f"x{i}", F.array(*map(F.lit, probabilities))).alias(f"q{i}") for i in range(len(columns))]).first()
        return {c: list(row[f"q{i}"] or [None] * len(probabilities)) for i, c in enumerate(columns)}
    counts = values.agg(*[F.count(f"x{i}").alias(f"n{i}") for i in range(len(columns))]).first()
    out = {}
    for i, c in enumerate(columns):
        n = counts[f"n{i}"]
        places = [p * (n - 1) for p in probabilities] if n else []
        own = values.select(F.col(f"x{i}").alias("x")).where("x is not null")
        ranked = _ranked(own, sorted({r for p in places for r in (math.floor(p), math.ceil(p))}), n)
        out[c] = [ranked[math.floor(p)] + (p - math.floor(p)) * (ranked[math.ceil(p)] - ranked[math.floor(p)]) for p in places] or [None] * len(probabilities)
    return out


def _ranked(own: DataFrame, ranks: list[int], n: int) -> dict[int, float]:
    """The value of each rank (from 0) among the n values x of a frame, by brackets that narrow until they hold few rows.

    A bracket is an open interval with the number of rows below and within it. A rank that falls on an end of a new bracket is
    found, so frequent values are no obstacle and every bracket has fewer rows than the one before.
    """
    bracket, out = dict.fromkeys(ranks, (None, None, 0, n)), {}
    inside = lambda low, high: (F.lit(True) if low is None else F.col("x") > low) & (F.lit(True) if high is None else F.col("x") < high)
    while open_ := {b for r, b in bracket.items() if r not in out and b[3] > EXACT_ROWS}:
        ends = {}
        for b in open_:
            mine = [r for r in ranks if r not in out and bracket[r] == b]
            near = [min(1.0, max(0.0, (r - b[2]) / b[3] + e)) for r in mine for e in (-SKETCH_ERROR, SKETCH_ERROR)]
            found = own.where(inside(*b[:2])).approxQuantile("x", near, SKETCH_ERROR / 2)
            ends |= {r: (found[2 * k], found[2 * k + 1]) for k, r in enumerate(mine)}
        points = sorted({x for pair in ends.values() for x in pair})
        row = own.agg(*[f for k, x in enumerate(points) for f in (F.count_if(F.col("x") < x).alias(f"b{k}"), F.count_if(F.col("x") == x).alias(f"e{k}"))]).first()
        below, equal = ({x: row[f"{c}{k}"] for k, x in enumerate(points)} for c in "be")
        for r, (low, high) in ends.items():
            for x in (low, high):
                if below[x] <= r < below[x] + equal[x]:
                    out[r] = x
            if r < below[low]:  # the sketch was off: all that is below
                bracket[r] = (bracket[r][0], low, bracket[r][2], below[low] - bracket[r][2])
            elif r >= below[high] + equal[high]:
                bracket[r] = (high, bracket[r][1], below[high] + equal[high], bracket[r][2] + bracket[r][3] - below[high] - equal[high])
            elif r not in out:
                bracket[r] = (low, high, below[low] + equal[low], below[high] - below[low] - equal[low])
    left = sorted({bracket[r] for r in ranks if r not in out}, key=str)
    if left:
        hits = F.array(*[F.when(inside(*b[:2]), F.lit(k)) for k, b in enumerate(left)])
        rows = own.select("x", F.explode(F.array_compact(hits)).alias("k"))
        place = F.row_number().over(Window.partitionBy("k").orderBy("x")) - 1  # EXACT_ROWS rows a bracket at most
        wanted = [(left.index(bracket[r]), r - bracket[r][2], r) for r in ranks if r not in out]
        chosen = reduce(lambda a, b: a | b, [(F.col("k") == k) & (F.col("place") == p) for k, p, _ in wanted])
        found = {(r["k"], r["place"]): r["x"] for r in rows.withColumn("place", place).where(chosen).collect()}
        out |= {r: found[k, p] for k, p, r in wanted}
    return out


def number(column: str) -> Column:
    """The column as double, with NULL for NaN."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, n, mean, std, min, q25, q50, q75, max, with exact quartiles. NaN is missing; a column without values has n = 0 and NULLs."""
    columns = columns or numeric_columns(df)
    rows, names, at = df.count(), ("q25", "q50", "q75"), [0.25, 0.5, 0.75]
    quartiles = None if rows <= EXACT_ROWS else exact_quantiles(df, columns, at, rows)
    aggs = []
    for i, c in enumerate(columns):
        x = number(c)
        aggs += [F.count(x).alias(f"n_{i}"), F.avg(x).alias(f"mean_{i}"), F.stddev_samp(x).alias(f"std_{i}"), F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}")]
        if quartiles:
            aggs += [F.lit(q).alias(f"{n}_{i}") for q, n in zip(quartiles[c], names)]
        else:
            aggs.append(F.percentile(x, F.array(*map(F.lit, at))).alias(f"q_{i}"))
    row = df.agg(*aggs)
    if not quartiles:
        row = row.withColumns({f"{n}_{i}": F.get(f"q_{i}", F.lit(k)) for i in range(len(columns)) for k, n in enumerate(names)})
    return _long(row, columns, {"n": "long"} | dict.fromkeys(("mean", "std", "min", *names, "max"), "double"))


def value_counts(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """value, n of the most frequent values; equal counts in the order of the value."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(top)


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """a, b, r for every pair, over the rows that have both; NULL where one of them is constant there."""
    columns = columns or numeric_columns(df)
    pairs = list(combinations(columns, 2))
    # by sums of squares: corr() divides by zero for a constant
    r = lambda x, y: F.try_divide(F.regr_sxy(x, y), F.sqrt(F.regr_sxx(x, y)) * F.sqrt(F.regr_syy(x, y)))
    row = df.agg(*[r(number(a), number(b)).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r_{i}").alias("r")) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """bin, n of equal bins from the least to the largest value; the last bin is closed."""
    x = number(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin long, n long")
    at = F.least(F.lit(bins - 1), F.floor((x - F.lit(low)) / F.lit((high - low) / bins or 1.0))).cast("long")
    return df.where(x.isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _long_values(a: DataFrame, b: DataFrame, columns: list[str], value: Callable[[str], Column]) -> DataFrame:
    """c (place of the column), x, u, v: how often each value that is not missing occurs in a and in b; one pass over each."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), value(c).alias("x")) for i, c in enumerate(columns)])
    side = lambda df, u, v: df.select(F.explode(cells).alias("e"), F.lit(u).alias("u"), F.lit(v).alias("v")).select("e.*", "u", "v")
    both = side(a, 1, 0).unionByName(side(b, 0, 1)).where("x is not null")
    return both.groupBy("c", "x").agg(F.sum("u").alias("u"), F.sum("v").alias("v"))


def cuts_below(cuts: list[list[float]], which: Column, x: Column, with_equal: bool = False) -> Column:
    """How many of the ascending cuts of a list are below x (with_equal: or equal to it); which: the place of the list. By binary search in Arrow batches."""
    sorted_cuts, side = [np.array(c, float) for c in cuts], "right" if with_equal else "left"

    @F.pandas_udf(IntegerType())
    def below(c: pd.Series, v: pd.Series) -> pd.Series:
        c, v, out = c.to_numpy(), v.to_numpy(float), np.zeros(len(c), np.int32)
        for k in np.unique(c).tolist():
            out[c == k] = np.searchsorted(sorted_cuts[k], v[c == k], side)
        return pd.Series(out)

    return below(which, x)


def _cumulative(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """c (place of the column), x, f, g, next_x, n, m: both distribution functions at each value (NULL of a side without values), and values of both sides.

    Values are counted first, for all columns in one pass. Running sums go over ranges with about as many rows each, and ranges are
    offset by the totals of the earlier ones.
    """
    x = [number(c).alias(f"x{i}") for i, c in enumerate(columns)]
    both = a.select(*x).unionByName(b.select(*x))
    ranges = max(RANGES, -(-both.count() // RANGE_ROWS))
    found = both.approxQuantile([f"x{i}" for i in range(len(columns))], [i / ranges for i in range(1, ranges)], min(0.005, 0.3 / ranges))
    counts = _long_values(a, b, columns, number).withColumn("part", cuts_below([sorted(set(q)) for q in found], F.col("c"), F.col("x")))
    every = Window.partitionBy("c").orderBy("part")  # one row a range
    totals = counts.groupBy("c", "part").agg(F.sum("u").alias("pu"), F.sum("v").alias("pv"), F.min("x").alias("first_x"))
    earlier = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("c", "part", F.coalesce(F.sum("pu").over(earlier), F.lit(0)).alias("bu"), F.coalesce(F.sum("pv").over(earlier), F.lit(0)).alias("bv"), F.lead("first_x").over(every).alias("later_x"), F.sum("pu").over(whole).alias("n"), F.sum("pv").over(whole).alias("m"))
    own = Window.partitionBy("c", "part").orderBy("x")
    running = own.rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select("c", "part", "x", F.sum("u").over(running).alias("ru"), F.sum("v").over(running).alias("rv"), F.lead("x").over(own).alias("own_next"))
    share = lambda r, before, n: F.try_divide(F.col(r) + F.col(before), F.col(n))
    return counts.join(F.broadcast(totals), ["c", "part"]).select("c", "x", share("ru", "bu", "n").alias("f"), share("rv", "bv", "m").alias("g"), F.coalesce("own_next", "later_x").alias("next_x"), "n", "m")


def distances(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """column, ks (largest distance of the two distribution functions), w1 (area between them), n, m (values of each side).

    NaN is missing. ks and w1 are NULL where a side has no value of the column.
    """
    gap = F.abs(F.col("f") - F.col("g"))
    found = _cumulative(a, b, columns).groupBy("c").agg(F.max(gap).alias("ks"), F.coalesce(F.sum(gap * (F.col("next_x") - F.col("x"))), F.lit(0.0)).alias("w1"), F.max("n").alias("n"), F.max("m").alias("m"))
    every = a.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column string")
    return every.join(found, "c", "left").select("column", "ks", F.when(F.col("ks").isNotNull(), F.col("w1")).alias("w1"), *[F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in "nm"])


def ks_statistic(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """ks: the largest distance of the two distribution functions."""
    return distances(a, b, [column]).select("ks")


def ks_p_value(ks: Column, n: Column, m: Column) -> Column:
    """The asymptotic two-sided p-value (a series of 100 terms)."""
    t = ks * F.sqrt(n * m / (n + m))
    total = 2 * sum(((-1) ** (k - 1)) * F.exp(-2.0 * k * k * t * t) for k in range(1, 101))
    return F.when(t < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def exact_ks_p_value(ks: float, n: int, m: int) -> float:
    """The two-sided p-value of small samples without ties: the share of all orders of both samples whose distance is ks or more.

    An order is a path of n steps one way and m the other. The chance to have kept below the distance is followed over all places that
    are equally many steps away, so it takes n + m steps over at most n + 1 numbers.
    """
    reach = round(ks * n * m) - 0.5  # distances are multiples of 1 / (n m)
    inside = np.ones(1)
    for steps in range(1, n + m + 1):
        i = np.arange(max(0, steps - m), min(n, steps) + 1)
        before = np.arange(max(0, steps - 1 - m), min(n, steps - 1) + 1)
        wide = np.zeros(n + 2)
        wide[before + 1] = inside
        inside = (i * wide[i] + (steps - i) * wide[i + 1]) / steps
        inside[np.abs(i * m - (steps - i) * n) > reach] = 0
    return float(min(1.0, max(0.0, 1 - inside[-1])))


@F.pandas_udf(DoubleType())
def _exact_p(ks: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(d) or not a or not b or max(a, b) > EXACT_KS else exact_ks_p_value(d, int(a), int(b)) for d, a, b in zip(ks, n, m)], dtype=float)


def ks_p_values(found: DataFrame) -> DataFrame:
    """found (a row a pair of samples, with ks, n and m) with p_value: exact for up to EXACT_KS values a side, asymptotic beyond."""
    return found.withColumn("p_value", F.coalesce(F.nanvl(_exact_p("ks", "n", "m"), F.lit(None).cast("double")), F.when((F.col("n") > 0) & (F.col("m") > 0), ks_p_value(F.col("ks"), F.col("n"), F.col("m")))))


def wasserstein(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """w1: the area between the two distribution functions."""
    return distances(a, b, [column]).select("w1")


def share_overlap(counts: DataFrame, by: str) -> DataFrame:
    """by, overlap: 1 - half the sum of the differences of the shares that each value has in u and in v; NULL if one of them has none."""
    totals = counts.groupBy(by).agg(F.sum("u").alias("nu"), F.sum("v").alias("nv"))  # a row a column, or a pair of columns
    parts = counts.join(F.broadcast(totals), by)
    return parts.groupBy(by).agg((1 - F.sum(F.abs(F.try_divide("u", "nu") - F.try_divide("v", "nv"))) / 2).alias("overlap"))


def overlaps(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """column, tv_complement: 1 - half the sum of the differences of category shares, of all columns in one pass; NULL if a side has no value."""
    found = share_overlap(_long_values(a, b, columns, lambda c: F.col(c).cast("string")), "c")
    every = a.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column string")
    return every.join(found, "c", "left").select("column", F.col("overlap").alias("tv_complement"))


def tv_complement(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """tv_complement: 1 - half the sum of the differences of category shares."""
    return overlaps(a, b, [column]).select("tv_complement")


def profile(df: DataFrame, sample_rows: int = 10_000, seed: int = 42) -> dict[str, DataFrame]:
    """Nulls, numbers and top values of a frame; the sample is a bounded share of it."""
    n = df.count()
    return {"nulls": null_profile(df), "numbers": describe(df), "sample": df.sample(min(1.0, sample_rows / max(n, 1)), seed), **{f"top_{c}": value_counts(df, c) for c in categorical_columns(df)}}
