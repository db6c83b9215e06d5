"""Fidelity of a synthetic table: shapes of columns, trends of pairs, missing values, statistics, chart tables."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from cohortloom.operators import stats, transforms
from cohortloom.sources import tables

#: Bins of a chart, and of a number in a pair with a category.
BINS, CONTINGENCY_BINS = 30, 10


def common_columns(real: DataFrame, synthetic: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """The wanted columns (none: all), in the real frame's order; it is an error if the frames differ in them."""
    wanted = wanted or real.columns
    if missing := [c for c in wanted if c not in real.columns or c not in synthetic.columns]:
        raise ValueError(f"not in both tables: {missing}")
    return wanted


def column_shapes(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    """property, column, score: 1 - KS of numbers, 1 - total variation of categories. NULL where a side has no value."""
    numeric = [c for c in columns if c in set(stats.numeric_columns(real))]
    other = [c for c in columns if c not in numeric]
    parts = []
    if numeric:
        parts.append(stats.distances(real, synthetic, numeric).select(F.lit("shape").alias("property"), "column", (1 - F.col("ks")).alias("score")))
    if other:
        parts.append(stats.overlaps(real, synthetic, other).select(F.lit("shape").alias("property"), "column", F.col("tv_complement").alias("score")))
    return reduce(DataFrame.unionByName, parts)


def pair_trends(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    """property, column ("a|b"), score: 1 - half the difference of the correlations of two numbers, contingency similarity of other pairs.

    Whatever the number of columns, correlations take one pass over each table, and so do all other pairs. NULL where a
    correlation has none (a constant), or a side has no row with both values.
    """
    numeric = [c for c in columns if c in set(stats.numeric_columns(real))]
    parts = [real.sparkSession.createDataFrame([], "property string, column string, score double")]
    if len(numeric) > 1:
        a, b = stats.correlations(real, numeric), stats.correlations(synthetic, numeric).withColumnRenamed("r", "s")
        both = a.join(b, ["a", "b"])
        parts.append(both.select(F.lit("trend").alias("property"), F.concat_ws("|", "a", "b").alias("column"), (1 - F.abs(F.col("r") - F.col("s")) / 2).alias("score")))
    mixed = [(a, b) for a, b in combinations(columns, 2) if a not in numeric or b not in numeric]
    if mixed:
        found = contingency(*_categories(real, synthetic, columns, numeric), mixed)
        parts.append(found.select(F.lit("trend").alias("property"), F.concat_ws("|", "a", "b").alias("column"), "score"))
    return reduce(DataFrame.unionByName, parts)


def _categories(real: DataFrame, synthetic: DataFrame, columns: list[str], numeric: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with numbers as one of CONTINGENCY_BINS equal bins of the real values (-1 below them, and one more above)."""
    ends = real.agg(*[f(stats.number(c)).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("l", F.min), ("h", F.max))]).first() if numeric else None
    bins = {}
    for i, c in enumerate(numeric):
        low, high, x = ends[f"l{i}"], ends[f"h{i}"], stats.number(c)
        if low is None:
            bins[c] = F.when(x.isNotNull(), F.lit(0))
            continue
        at = F.least(F.lit(CONTINGENCY_BINS - 1), F.floor((x - F.lit(low)) / F.lit((high - low) / CONTINGENCY_BINS or 1.0)).cast("int"))
        bins[c] = F.when(x < low, -1).when(x > high, CONTINGENCY_BINS).when(x.isNotNull(), at)
    made = [bins.get(c, F.col(c)).cast("string").alias(c) for c in columns]
    return real.select(*made), synthetic.select(*made)


def contingency(real: DataFrame, synthetic: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """a, b, score: 1 - half the sum of the differences of the shares of each pair of values, over the rows that have both; all pairs of columns in one pass."""
    cells = F.array(*[F.struct(F.lit(k).alias("pair"), F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")) for k, (a, b) in enumerate(pairs)])
    side = lambda df, u, v: df.select(F.explode(cells).alias("e"), F.lit(u).alias("u"), F.lit(v).alias("v")).select("e.*", "u", "v")
    both = side(real, 1, 0).unionByName(side(synthetic, 0, 1)).where("x is not null and y is not null")
    counts = both.groupBy("pair", "x", "y").agg(F.sum("u").alias("u"), F.sum("v").alias("v"))
    every = real.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "pair int, a string, b string")
    return every.join(stats.share_overlap(counts, "pair"), "pair", "left").select("a", "b", F.col("overlap").alias("score"))


def quality(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    """property, score: the mean of each property, and the mean of those as 'overall'. NULL scores do not count."""
    details = column_shapes(real, synthetic, columns).unionByName(pair_trends(real, synthetic, columns))
    by = details.groupBy("property").agg(F.avg("score").alias("score"))
    return by.unionByName(by.agg(F.lit("overall").alias("property"), F.avg("score").alias("score")))


def compare_nulls(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    names = lambda f, p: f.withColumnsRenamed({"n_null": f"{p}_n_null", "pct_null": f"{p}_pct_null"})
    return names(stats.null_profile(real.select(columns)), "real").join(names(stats.null_profile(synthetic.select(columns)), "synthetic"), "column")


def correlation_difference(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, difference (synthetic - real)."""
    a, b = stats.correlations(real, columns), stats.correlations(synthetic, columns).withColumnRenamed("r", "s")
    return a.join(b, ["a", "b"]).select("a", "b", (F.col("s") - F.col("r")).alias("difference"))


def describe_difference(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    """column, and synthetic - real of n, mean, std, min, quartiles and max."""
    a, b = stats.describe(real, columns), stats.describe(synthetic, columns)
    names = [c for c in a.columns if c != "column"]
    return a.join(b.withColumnsRenamed({c: f"s_{c}" for c in names}), "column").select("column", *[(F.col(f"s_{c}") - F.col(c)).alias(c) for c in names])


def audit(real: DataFrame, synthetic: DataFrame, columns: list[str] | None = None) -> dict[str, DataFrame]:
    """All tables of an audit; charts are tables of bins and counts."""
    columns = common_columns(real, synthetic, columns)
    numeric = [c for c in columns if c in set(stats.numeric_columns(real))]
    out = {"quality": quality(real, synthetic, columns), "nulls": compare_nulls(real, synthetic, columns)}
    if numeric:
        out |= {"real_numbers": stats.describe(real, numeric), "synthetic_numbers": stats.describe(synthetic, numeric), "number_differences": describe_difference(real, synthetic, numeric)}
    if len(numeric) > 1:
        out["correlations"] = correlation_difference(real, synthetic, numeric)
    for side, frame in (("real", real), ("synthetic", synthetic)):
        out |= {f"{side}_histogram_{c}": stats.histogram(frame, c, BINS) for c in numeric}
        out |= {f"{side}_counts_{c}": stats.value_counts(frame, c) for c in [c for c in columns if c not in numeric][:5]}
    return out


def run(real: DataFrame, synthetic: DataFrame, folder: str, columns: list[str] | None = None, plausible: bool = True) -> dict[str, list[dict]]:
    """The audit stage: plausible rows only, intervals as days, every table of audit() as one JSON report in the folder.

    The tables have a row a column, pair, bin or frequent value, so the report is small whatever the frames are.
    """
    if plausible:
        real, synthetic = transforms.plausible(real), transforms.plausible(synthetic)
    real, synthetic = transforms.intervals_to_days(real), transforms.intervals_to_days(synthetic)
    if real.isEmpty() or synthetic.isEmpty():
        raise ValueError("a table without rows cannot be audited")
    report = {name: [r.asDict() for r in table.collect()] for name, table in audit(real, synthetic, columns).items()}
    tables.write_json(real.sparkSession, report, f"{folder}/audit_report.json")
    return report
