"""Statistics, audit and privacy on columns without values, constant columns and empty tables; exact p-values; tolerance; control rows."""

import math
from collections import Counter
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import stats
from cohortloom.plans import audit, privacy

SCHEMA = "key int, x double, nothing double, same double, word string, empty string, one string"


def rows(spark, start, n, real=True):
    return spark.createDataFrame([(start + i, float("nan") if i % 7 == 0 else (i * 37 % 11) / 3, None, 4.0, "abc"[i % 3], None, "w") for i in range(n)], SCHEMA).withColumn("half", F.when(F.lit(real), F.col("x")))


def test_statistics_at_the_edges(spark):
    a, b = rows(spark, 0, 40), rows(spark, 100, 30, False)
    found = {r.column: r for r in stats.distances(a, b, ["x", "nothing", "same", "half"]).collect()}
    assert (found["nothing"].ks, found["nothing"].w1, found["nothing"].n) == (None, None, 0)
    assert (found["half"].ks, found["half"].w1, found["half"].m) == (None, None, 0) and found["half"].n == found["x"].n == 34
    assert (found["same"].ks, found["same"].w1, found["same"].m) == (0.0, 0.0, 30)
    none = a.limit(0)
    assert stats.ks_statistic(a, none, "x").first().ks is None and stats.wasserstein(none, none, "x").first().w1 is None
    assert stats.tv_complement(a, b, "empty").first()[0] is None and stats.tv_complement(a, none, "word").first()[0] is None and stats.tv_complement(a, b, "one").first()[0] == 1.0
    by = {r.column: r for r in stats.describe(a, ["x", "nothing", "same"]).collect()}
    values = sorted((i * 37 % 11) / 3 for i in range(40) if i % 7)
    assert by["x"].n == 34 and by["x"].max == values[-1] and by["x"].mean == pytest.approx(sum(values) / 34) and by["x"].q50 == pytest.approx((values[16] + values[17]) / 2)
    assert by["nothing"].n == 0 and by["nothing"].q25 is None and by["same"].std == 0
    assert {(r.a, r.b): r.r for r in stats.correlations(a, ["x", "nothing", "same"]).collect()} == {("x", "nothing"): None, ("x", "same"): None, ("nothing", "same"): None}


@pytest.mark.parametrize("sizes", [(40, 30), (0, 30)])
def test_audit_and_privacy_at_the_edges(spark, sizes):
    a, b = rows(spark, 0, sizes[0]), rows(spark, 100, sizes[1], False)
    columns = ["x", "nothing", "same", "word", "empty", "one", "half"]
    found = {r.property: r.score for r in audit.quality(a, b, columns).collect()}
    assert set(found) == {"shape", "trend", "overall"}
    if all(sizes):
        shapes = {r.column: r.score for r in audit.column_shapes(a, b, columns).collect()}
        assert shapes["nothing"] is shapes["half"] is shapes["empty"] is None and shapes["same"] == shapes["one"] == 1.0 and 0 < found["overall"] <= 1
    else:
        assert found == dict.fromkeys(("shape", "trend", "overall"))
    for table in audit.audit(a, b, columns).values():
        table.collect()
    report = {(r.section, r.column, r.metric): r.value for r in privacy.evaluate(a, b, "key", control=b, tolerance=0.01, exact=True).collect()}
    assert ("numeric", "nothing", "ks") in report and report["numeric", "nothing", "ks"] is None and report["numeric", "half", "p_value"] is None
    assert ("linkability", "", "control_rate") in report
    assert privacy.numerical_lr(a, b, "same", "x").first() is None or privacy.numerical_lr(a, b, "same", "x").first().slope is None


def test_exact_p_values_equal_enumeration(spark):
    for n, m in product(range(1, 9), repeat=2):
        counts = Counter()
        for chosen in combinations(range(n + m), n):
            seen, most = 0, 0
            for k in range(n + m):
                seen += k in chosen
                most = max(most, abs(seen * m - (k + 1 - seen) * n))
            counts[most] += 1
        for d in counts:
            assert stats.exact_ks_p_value(d / n / m, n, m) == pytest.approx(sum(v for k, v in counts.items() if k >= d) / math.comb(n + m, n), abs=1e-12)
    assert stats.exact_ks_p_value(0.05, 9000, 9000) == pytest.approx(spark.range(1).select(stats.ks_p_value(F.lit(0.05), F.lit(9000.0), F.lit(9000.0))).first()[0], rel=0.02)
    made = stats.ks_p_values(spark.createDataFrame([(0.5, 8, 8), (0.01, 20_000, 20_000), (None, 0, 5)], "ks double, n long, m long")).collect()
    assert made[0].p_value == pytest.approx(stats.exact_ks_p_value(0.5, 8, 8)) and 0.2 < made[1].p_value < 0.3 and made[2].p_value is None


def test_rows_within_a_tolerance(spark):
    import random

    rng = random.Random(2)
    value = lambda: rng.choice([0.0, None, rng.uniform(-3, 3), float(round(rng.uniform(90, 110))), -100.0])
    real = [(rng.choice("ab"), value(), rng.choice([5, -5, 1000]), value()) for _ in range(300)]
    synthetic = [(rng.choice(["a", "b", None]), value(), rng.choice([5, -5, 1005]), value()) for _ in range(300)] + [(w, None if x is None else x * (1 + rng.choice([0.0099, -0.0099, 0.0101])), y, z) for w, x, y, z in real[:100]] * 2
    schema = "w string, x double, y int, z double"
    near = lambda r, s: r == s or (r is not None and s is not None and not isinstance(r, str) and abs(r - s) <= 0.01 * abs(s))
    new = sum(not any(all(near(r, s) for r, s in zip(a, b)) for a in real) for b in synthetic)
    row = privacy.new_row_share(spark.createDataFrame(real, schema), spark.createDataFrame(synthetic, schema), list("wxyz"), 0.01).first()
    assert (row.n, row.n_new) == (500, new) and 0 < new < 500 and row.share == pytest.approx(new / 500)
    with pytest.raises(ValueError):
        privacy.new_row_share(spark.createDataFrame(real, schema), spark.createDataFrame(real, schema), list("wxyz"), 1.5)


def test_control_rows(spark):
    real, synthetic, control = (spark.range(k, 900, 3).select(F.col("id").alias("key"), F.sin("id").alias("a"), F.cos(F.col("id") * 2).alias("b")) for k in range(3))
    known = real.sample(0.5, 3).unionByName(synthetic)  # a table that holds half of the real rows
    attack = lambda rows: privacy.linkability(rows, known, "key", ["a"], ["b"], F.lit(True), 1)
    row = privacy.with_control(attack(real), attack(control), "n_linked").first()
    assert row.n_attacks == row.n_control == 300 and row.rate > row.control_rate
    assert row.rate_low < row.rate < row.rate_high and row.control_low <= row.control_rate < row.control_high
    p, z, n = row.rate, privacy.Z95, 300
    assert row.rate_low == pytest.approx((p + z * z / 2 / n - z * math.sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n))
    assert row.excess == pytest.approx((row.rate - row.control_rate) / (1 - row.control_rate))


def test_profile_and_own_means(spark):
    df = rows(spark, 0, 40)
    made = stats.profile(df, 10)
    assert {r.column: r.n_null for r in made["nulls"].collect()}["nothing"] == 40
    assert {r.column for r in made["numbers"].collect()} >= {"key", "x", "nothing", "same"} and made["sample"].count() < 40
    assert [(r.value, r.n) for r in made["top_word"].collect()] == [("a", 14), ("b", 13), ("c", 13)] and made["top_empty"].count() == 0
    from cohortloom.operators.features import impute_mean

    some = spark.createDataFrame([(1.0, None), (None, None), (5.0, None)], "a double, b double")
    assert sorted(map(tuple, impute_mean(some, ["a", "b"]).collect())) == [(1.0, None), (3.0, None), (5.0, None)]


def test_cuts_are_counted_by_list(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 2.0), (1, 9.0), (0, None)], "c int, x double")
    found = [(r.a, r.b) for r in df.select(stats.cuts_below([[1.0, 2.0], [5.0]], F.col("c"), F.col("x")).alias("a"), stats.cuts_below([[1.0, 2.0], [5.0]], F.col("c"), F.col("x"), True).alias("b")).collect()]
    assert found[:4] == [(0, 1), (1, 2), (0, 0), (1, 1)]
