"""Privacy metrics of a synthetic table against the real one. Every metric says which direction is riskier."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.operators import stats, transforms
from cohortloom.operators.features import impute_mean
from cohortloom.operators.neighbours import nearest
from cohortloom.sources import tables


#: Numbers that rows are looked up by if they may differ.
GRID_COLUMNS = 2
#: The quantile of a normal distribution for 95 % intervals.
Z95 = 1.959963984540054
#: What an attack's row has besides if there are control rows.
CONTROLLED = ("rate_low", "rate_high", "control_rate", "control_low", "control_high", "excess")


def scaled_pair(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with their own means for what is missing, and with the real frame's standard scores (ddof 0)."""
    real, synthetic = impute_mean(real, columns), impute_mean(synthetic, columns)
    row = real.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    scale = {c: (F.col(c) - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}
    return real.withColumns(scale), synthetic.withColumns(scale)


def new_row_share(real: DataFrame, synthetic: DataFrame, columns: list[str], tolerance: float = 0.0) -> DataFrame:
    """n, n_new, share of synthetic rows that no real row matches (higher is safer; share is NULL without rows).

    A row matches if all its values are equal (NULL equals NULL); a number x of the synthetic row also matches what differs by tolerance * |x| at most.
    """
    if not 0 <= tolerance < 1:
        raise ValueError("a tolerance of 0 or more and below 1 is expected")
    numeric = [c for c in stats.numeric_columns(real) if c in columns] if tolerance else []
    if numeric:
        return _new_rows_by_cells(real, synthetic, columns, numeric, tolerance)
    seen = real.select(*columns).distinct().withColumn("seen", F.lit(1))
    on = reduce(lambda a, b: a & b, [synthetic[c].eqNullSafe(seen[c]) for c in columns])
    found = synthetic.join(seen, on, "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("seen").isNull(), 1).otherwise(0)), F.lit(0)).alias("n_new")).withColumn("share", F.try_divide("n_new", "n"))


def _new_rows_by_cells(real: DataFrame, synthetic: DataFrame, columns: list[str], numeric: list[str], tolerance: float) -> DataFrame:
    """Numbers lie in cells by sign and logarithm, as wide as the tolerance, so a match is in the same cell or next to it.

    The GRID_COLUMNS numbers with the most cells, and all categories, are keys of the join; a synthetic row goes to 3 cells a number. The other
    numbers are compared where the rows meet. Equal rows are one on either side, so a frequent row is no hot key.
    """
    width = -math.log1p(-tolerance) * (1 + 1e-9)
    x = {c: stats.number(c) for c in numeric}
    cell = {c: F.coalesce(F.when(v == 0, 0).otherwise(F.floor(F.log(F.abs(v)) / width)), F.lit(0)) for c, v in x.items()}
    sign = {c: F.coalesce(F.signum(v), F.lit(2.0)) for c, v in x.items()}
    spread = real.agg(*[F.approx_count_distinct(F.struct(sign[c], cell[c])).alias(f"d{i}") for i, c in enumerate(numeric)]).first()
    grid = sorted(numeric, key=lambda c: -spread[f"d{numeric.index(c)}"])[:GRID_COLUMNS]
    keys = {f"s{i}": sign[c] for i, c in enumerate(grid)} | {f"k{i}": cell[c] for i, c in enumerate(grid)}
    names = {c: f"r_{i}" for i, c in enumerate(columns)}
    a = real.select(*columns).distinct().withColumns(keys).withColumnsRenamed(names)
    b = synthetic.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).withColumns(keys).withColumn("row", F.struct(*columns))
    asks = b
    for i in range(len(grid)):
        near = F.when(F.abs(F.col(f"s{i}")) == 1, F.array(*[F.col(f"k{i}") + d for d in (-1, 0, 1)])).otherwise(F.array(f"k{i}"))
        asks = asks.withColumn(f"k{i}", F.explode(near))
    on = [asks[k] == a[k] for k in keys]
    for c in columns:
        equal = asks[c].eqNullSafe(a[names[c]])
        on.append(equal if c not in numeric else equal | (F.abs(asks[c].cast("double") - a[names[c]].cast("double")) <= tolerance * F.abs(asks[c].cast("double"))))
    found = asks.join(a, reduce(lambda p, q: p & q, on), "left_semi").select("row", "rows").distinct()
    totals = b.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).crossJoin(found.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("known")))  # one row each
    return totals.select("n", (F.col("n") - F.col("known")).alias("n_new")).withColumn("share", F.try_divide("n_new", "n"))


def closest_records(real: DataFrame, synthetic: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """synthetic_id, real_id, distance of each synthetic row's nearest real row (scaled). DiSCO and membership share it."""
    a, b = scaled_pair(real, synthetic, columns)
    return nearest(b.withColumnRenamed(key, "synthetic_id"), a.withColumnRenamed(key, "real_id"), "synthetic_id", "real_id", columns).drop("place")


def distance_stats(distances: DataFrame, rows: int | None = None) -> DataFrame:
    """mean, median, min, max, std (ddof 0) of the distances. rows: their number, if known; keep many distances (persist) first."""
    d = F.col("distance")
    if rows is not None and rows <= stats.EXACT_ROWS:
        median = F.percentile(d, F.lit(0.5))  # few enough for one task, and the distances are computed once
    else:
        median = F.lit(stats.exact_quantiles(distances, ["distance"], [0.5], rows)["distance"][0]).cast("double")
    return distances.agg(F.avg(d).alias("mean"), median.alias("median"), F.min(d).alias("min"), F.max(d).alias("max"), F.stddev_pop(d).alias("std"))


def membership_inference(distances: DataFrame, rows: int | None = None) -> DataFrame:
    """threshold (10th percentile), n_below, rate (higher is riskier; about 0.1 by the choice of the threshold)."""
    threshold = F.lit(stats.exact_quantiles(distances, ["distance"], [0.1], rows)["distance"][0]).cast("double")
    below = F.col("distance") < threshold
    return distances.agg(threshold.alias("threshold"), F.sum(below.cast("long")).alias("n_below"), F.avg(below.cast("double")).alias("rate"))


def attribute_disclosure(real: DataFrame, synthetic: DataFrame, key: str, known: list[str], sensitive: list[str]) -> DataFrame:
    """column, mae, relative_mae, risk: how well the nearest synthetic row by the known columns tells a sensitive one.

    risk = 1 - mae / range, at least 0 (higher is riskier). Rows without the value do not count.
    """
    a, b = scaled_pair(real.select(key, *known), synthetic.select(key, *known), known)
    near = nearest(a.withColumnRenamed(key, "real_id"), b.withColumnRenamed(key, "synthetic_id"), "real_id", "synthetic_id", known)
    truth = real.select(F.col(key).alias("real_id"), *[F.col(c).cast("double").alias(f"t_{c}") for c in sensitive])
    guess = synthetic.select(F.col(key).alias("synthetic_id"), *[F.col(c).cast("double").alias(f"g_{c}") for c in sensitive])
    both = near.join(truth, "real_id").join(guess, "synthetic_id")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"t_{c}").alias("t"), F.col(f"g_{c}").alias("g")) for c in sensitive])
    long = both.select(F.explode(cells).alias("c")).select("c.*")
    out = long.groupBy("column").agg(F.avg(F.abs(F.col("t") - F.col("g"))).alias("mae"), (F.max("t") - F.min("t")).alias("range"), F.sum((F.col("t").isNotNull() & F.col("g").isNotNull()).cast("long")).alias("n_used"))
    relative = F.when(F.col("range") > 0, F.col("mae") / F.col("range")).otherwise(F.when(F.col("mae").isNotNull(), 0.0))
    return out.select("column", "mae", relative.alias("relative_mae"), F.greatest(F.lit(0.0), 1 - relative).alias("risk"), "n_used")


def categorical_cap(real: DataFrame, synthetic: DataFrame, known: list[str], sensitive: str) -> DataFrame:
    """n, n_covered, protection = 1 - mean chance that a real row's sensitive value is the one its key has in the synthetic table.

    Rows whose key the synthetic table lacks do not count (higher is safer).
    """
    pairs = synthetic.groupBy(*known, F.col(sensitive).alias("s")).agg(F.count(F.lit(1)).alias("k"))
    keys = pairs.groupBy(*known).agg(F.sum("k").alias("total"))
    rows = real.groupBy(*known, F.col(sensitive).alias("s")).agg(F.count(F.lit(1)).alias("w"))
    found = rows.join(keys, known, "left").join(pairs, [*known, "s"], "left")
    chance = F.coalesce(F.col("k"), F.lit(0)) / F.col("total")
    covered = F.when(F.col("total").isNotNull(), F.col("w")).otherwise(0)
    return found.agg(F.sum("w").alias("n"), F.sum(covered).alias("n_covered"), (1 - F.sum(covered * chance) / F.sum(covered)).alias("protection"))


def numerical_lr(real: DataFrame, synthetic: DataFrame, known: str, sensitive: str) -> DataFrame:
    """slope, intercept of the synthetic table, and the mean absolute error on the real one over its range (higher is safer).

    NULL where the known column is constant in the synthetic table, or the sensitive one in the real table.
    """
    y, x = stats.number(sensitive), stats.number(known)
    fit = synthetic.agg(F.regr_sxy(y, x).alias("xy"), F.regr_sxx(y, x).alias("xx"), F.regr_avgy(y, x).alias("y"), F.regr_avgx(y, x).alias("x"))
    fit = fit.withColumn("slope", F.try_divide("xy", "xx")).select("slope", (F.col("y") - F.col("slope") * F.col("x")).alias("intercept"))
    rows = real.crossJoin(F.broadcast(fit))  # fit is one row
    error = F.abs(F.col(sensitive) - (F.col("slope") * F.col(known) + F.col("intercept")))
    return rows.groupBy("slope", "intercept").agg(F.try_divide(F.avg(error), (F.max(sensitive) - F.min(sensitive)).cast("double")).alias("relative_error"))


def linkability(real: DataFrame, synthetic: DataFrame, key: str, left: list[str], right: list[str], attack: Column, k: int = 10) -> DataFrame:
    """n_attacks, n_linked, rate, baseline, risk: attacked rows whose k nearest synthetic rows by the left and by the right columns meet.

    attack picks the rows that are attacked, a deterministic query set. baseline: the chance that two random sets of k rows
    meet; risk = rate - baseline (higher is riskier).
    """
    a, b = scaled_pair(real, synthetic, [*left, *right])
    attacked = a.where(attack).withColumnRenamed(key, "real_id")
    table = b.withColumnRenamed(key, "synthetic_id")
    n = synthetic.count()
    apart = math.prod(max(0, n - k - i) / (n - i) for i in range(min(k, n)))
    by = [nearest(attacked, table, "real_id", "synthetic_id", c, k).select("real_id", "synthetic_id") for c in (left, right)]
    linked = by[0].join(by[1], ["real_id", "synthetic_id"]).select("real_id").distinct().withColumn("hit", F.lit(1))
    row = attacked.select("real_id").join(linked, "real_id", "left").agg(F.count(F.lit(1)).alias("n_attacks"), F.count("hit").alias("n_linked"), F.avg(F.coalesce(F.col("hit"), F.lit(0)).cast("double")).alias("rate"))
    return row.withColumn("baseline", F.lit(1 - apart)).withColumn("risk", F.col("rate") - F.col("baseline"))


def singling_out(real: DataFrame, synthetic: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_attacks, n_singled, rate, baseline, risk of univariate predicates that come from the synthetic table.

    An attack guesses that exactly one real row has a value that exactly one synthetic row has. baseline: the share of all values
    of either table that exactly one real row has, which is what a guess without the synthetic counts achieves; risk = rate -
    baseline (higher is riskier).
    """
    parts = []
    for c in columns:
        counts = lambda d, n: d.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias(n))  # noqa: E731, B023
        both = counts(real, "u").join(counts(synthetic, "v"), "value", "full_outer")
        attack, single = F.coalesce(F.col("v") == 1, F.lit(False)), F.coalesce(F.col("u") == 1, F.lit(False))
        row = both.agg(F.count_if(attack).alias("n_attacks"), F.count_if(attack & single).alias("n_singled"), F.avg(single.cast("double")).alias("baseline"))
        parts.append(row.select(F.lit(c).alias("column"), "n_attacks", "n_singled", F.when(F.col("n_attacks") > 0, F.col("n_singled") / F.col("n_attacks")).alias("rate"), "baseline"))
    return reduce(DataFrame.unionByName, parts).withColumn("risk", F.col("rate") - F.col("baseline"))


def inference(real: DataFrame, synthetic: DataFrame, key: str, known: list[str], secret: str, attack: Column, tolerance: float = 0.05) -> DataFrame:
    """n_attacks, n_right, rate, baseline, risk: attacked rows whose secret the nearest synthetic row by the known columns tells.

    A guess is right if it differs by tolerance x the true number at most (a category: if it is equal). baseline: the same with one
    guess for all rows, the synthetic median (the most frequent category, ties to the first); risk = rate - baseline.
    """
    number = secret in stats.numeric_columns(real)
    a, b = scaled_pair(real.select(key, *known), synthetic.select(key, *known), known)
    truth = real.where(attack & F.col(secret).isNotNull()).select(F.col(key).alias("real_id"), F.col(secret).alias("true"))
    near = nearest(a.where(attack).withColumnRenamed(key, "real_id"), b.withColumnRenamed(key, "synthetic_id"), "real_id", "synthetic_id", known)
    guesses = synthetic.select(F.col(key).alias("synthetic_id"), F.col(secret).alias("guess"))
    if number:
        blind = F.lit(stats.exact_quantiles(synthetic, [secret], [0.5])[secret][0]).cast("double")
        right = lambda g: F.coalesce(F.abs(g - F.col("true")) <= tolerance * F.abs(F.col("true")), F.lit(False))
    else:
        top = stats.value_counts(synthetic, secret, 1).first()
        blind = F.lit(top["value"] if top else None)
        right = lambda g: F.coalesce(g == F.col("true"), F.lit(False))
    both = truth.join(near.join(guesses, "synthetic_id").select("real_id", "guess"), "real_id", "left")
    row = both.agg(F.count(F.lit(1)).alias("n_attacks"), F.count_if(right(F.col("guess"))).alias("n_right"), F.avg(right(blind).cast("double")).alias("baseline"))
    return row.select("n_attacks", "n_right", F.when(F.col("n_attacks") > 0, F.col("n_right") / F.col("n_attacks")).alias("rate"), "baseline").withColumn("risk", F.col("rate") - F.col("baseline"))


def success_bounds(hits: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """The ends of the score interval of a rate of success; NULL without attempts."""
    p = F.try_divide(hits, n)
    middle, width = (p + z * z / 2 / n) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / 4 / n / n) / (1 + z * z / n)
    some = n > 0
    return F.when(some, F.greatest(F.lit(0.0), F.try_subtract(middle, width))), F.when(some, F.least(F.lit(1.0), middle + width))


def with_control(attack: DataFrame, control: DataFrame, hits: str) -> DataFrame:
    """An attack's row (or a row a column) with the bounds of its rate, and those of the same attack on rows that the synthetic table was not made from.

    control_rate is what general knowledge achieves; excess = (rate - control_rate) / (1 - control_rate), at least 0, is what is told of
    the real rows beyond that.
    """
    n = F.when(F.col("n_attacks") > 0, F.col("n_attacks").cast("double"))
    low, high = success_bounds(F.col(hits), n)
    own = attack.withColumns({"rate_low": low, "rate_high": high})
    other = control.select(*(["column"] if "column" in control.columns else []), F.col("n_attacks").alias("n_control"), F.col("rate").alias("control_rate"), low.alias("control_low"), high.alias("control_high"))
    both = own.join(other, "column", "left") if "column" in control.columns else own.crossJoin(other)  # one row each
    return both.withColumn("excess", F.greatest(F.lit(0.0), F.try_divide(F.col("rate") - F.col("control_rate"), 1 - F.col("control_rate"))))


def risk_band(risk: Column) -> Column:
    return F.when(risk < 0.1, "low").when(risk < 0.3, "medium").when(risk.isNotNull(), "high")


def evaluate(real: DataFrame, synthetic: DataFrame, key: str, attack: Column | None = None, control: DataFrame | None = None, tolerance: float = 0.0, exact: bool = False) -> DataFrame:
    """section, column, metric, value of all metrics over the columns that both frames have, and the mean of the risks.

    attack picks the rows that linkability and inference attack (without it, those whose key is divisible by 20). The metrics are a
    few numbers a column, so each is computed at once and the distances that several of them share are released. A metric that a
    column has none of (no values, or a constant) is NULL and does not count.

    control: real rows that the synthetic table was not made from; the attacks are made on them, too, and get control_rate and
    bounds. tolerance: how far numbers of equal rows may differ; exact: p-values are exact for small samples.
    """
    common = [c for c in real.columns if c in synthetic.columns and c != key]
    if not common:
        raise ValueError("the two tables have no column in common")
    attack = F.pmod(F.col(key).cast("long"), F.lit(20)) == 0 if attack is None else attack
    numeric = [c for c in stats.numeric_columns(real) if c in common]
    categorical = [c for c in stats.categorical_columns(real) if c in common]
    rows: list[tuple] = []

    def add(row: DataFrame, section: str, names: list[str], column: str = "") -> None:
        for r in row.collect():
            rows.extend((section, r["column"] if "column" in row.columns else column, n, None if r[n] is None else float(r[n])) for n in names)

    def attacked(made: Callable[[DataFrame], DataFrame], section: str, hits: str, column: str = "") -> None:
        row = made(real)
        if control is not None:
            row = with_control(row, made(control), hits)
        add(row, section, ["rate", "baseline", "risk", *(CONTROLLED if control is not None else ())], column)

    add(new_row_share(real, synthetic, common, tolerance), "new_rows", ["share"])
    if numeric:
        found = stats.distances(real, synthetic, numeric)
        found = stats.ks_p_values(found) if exact else found.withColumn("p_value", F.when(F.col("ks").isNotNull(), stats.ks_p_value(F.col("ks"), F.col("n"), F.col("m"))))
        add(found, "numeric", ["ks", "p_value", "w1"])
    for c in numeric[1:]:
        add(numerical_lr(real, synthetic, numeric[0], c), "numerical_lr", ["relative_error"], c)
    for c in categorical[1:]:
        add(categorical_cap(real, synthetic, [categorical[0]], c), "cap", ["protection"], c)
    attacked(lambda rows: singling_out(rows, synthetic, common), "singling_out", "n_singled")
    if numeric:
        near, n = closest_records(real, synthetic, key, numeric).persist(StorageLevel.DISK_ONLY), synthetic.count()
        add(distance_stats(near, n), "closest", ["mean", "median", "min", "max", "std"])
        add(membership_inference(near, n), "membership", ["threshold", "rate"])
        near.unpersist()
    if len(numeric) > 1:
        known, sensitive = numeric[: min(3, len(numeric) - 1)], numeric[min(3, len(numeric) - 1) :][:3]
        add(attribute_disclosure(real, synthetic, key, known, sensitive), "attribute", ["risk"])
        attacked(lambda rows: linkability(rows, synthetic, key, numeric[:1], numeric[1:2], attack), "linkability", "n_linked")
        attacked(lambda rows: inference(rows, synthetic, key, numeric[1:4], numeric[0], attack), "inference", "n_right", numeric[0])
    risks = {s: [v for section, _, m, v in rows if section == s and m == ("rate" if s == "membership" else "risk") and v is not None] for s in ("singling_out", "linkability", "inference", "membership", "attribute")}
    means = [sum(v) / len(v) for v in risks.values() if v]
    if means:
        rows.append(("summary", "", "mean_risk", sum(means) / len(means)))
    return real.sparkSession.createDataFrame(rows, "section string, column string, metric string, value double")


def run(real: DataFrame, synthetic: DataFrame, key: str, folder: str, plausible: bool = True, control: DataFrame | None = None, tolerance: float = 0.01) -> dict[str, dict]:
    """The privacy stage: plausible rows only, intervals as days, the metrics with the band of each risk as one JSON report in the folder.

    Without control rows, synthetic ones stand in for them (those whose key is divisible by 4), so control_rate is then what the attacks achieve on rows they know.
    """
    if plausible:
        real, synthetic = transforms.plausible(real), transforms.plausible(synthetic)
    real, synthetic = transforms.intervals_to_days(real), transforms.intervals_to_days(synthetic)
    if control is None:
        control = synthetic.where(F.pmod(F.col(key).cast("long"), F.lit(4)) == 0)
    banded = evaluate(real, synthetic, key, control=control, tolerance=tolerance, exact=True).withColumn("band", F.when(F.col("metric").isin("risk", "mean_risk"), risk_band(F.col("value"))))
    report: dict[str, dict] = {}
    for r in banded.collect():
        report.setdefault(r["section"], {}).setdefault(r["column"], {})[r["metric"]] = r["value"] if r["band"] is None else {"value": r["value"], "band": r["band"]}
    tables.write_json(real.sparkSession, report, f"{folder}/privacy_report.json")
    return report
