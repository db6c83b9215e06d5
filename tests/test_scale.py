"""Exact quantiles and nearest neighbours by the paths that large tables take."""

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from cohortloom.operators import features, neighbours, stats
from cohortloom.plans import audit, privacy, synthesis


@pytest.mark.parametrize("kind", ["spread", "ties", "one value", "two values"])
def test_quantiles_in_brackets_equal_percentile(spark, monkeypatch, kind):
    rng = np.random.default_rng(2)
    x = {"spread": rng.normal(size=5000) ** 3, "ties": rng.integers(0, 12, 5000).astype(float), "one value": np.full(5000, 2.5), "two values": np.repeat([1.0, 4.0], 2500)}[kind]
    rows = [(float(v), None if i % 3 else float(i)) for i, v in enumerate(x)] + [(None, None), (float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double")
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    monkeypatch.setattr(stats, "EXACT_ROWS", 60)
    got = stats.exact_quantiles(df, ["a", "b"], probabilities)
    assert np.allclose(got["a"], np.quantile(x, probabilities), atol=1e-9)
    assert np.allclose(got["b"], np.quantile(np.arange(0, 5000, 3), probabilities), atol=1e-9)
    assert stats.exact_quantiles(df.limit(0), ["a"], [0.5], rows=100) == {"a": [None]}


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("block", [8192, 40])
def test_neighbours_equal_brute_force(spark, monkeypatch, k, block):
    monkeypatch.setattr(neighbours, "BLOCK_POINTS", block)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 90)
    rng = np.random.default_rng(7)
    table = np.concatenate([rng.normal(size=(500, 2)), np.tile([[0.5, -0.0]], (200, 1)), rng.integers(0, 3, (100, 2))]).round(2)
    queries = np.concatenate([rng.normal(size=(120, 2)) * 2, np.tile([[0.5, 0.0]], (30, 1)), [[90.0, -70.0]]]).round(2)
    t = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(table)] + [(9000, None, 1.0)], "t long, a double, b double")
    q = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(queries)] + [(9000, 1.0, None)], "q long, a double, b double")
    got = sorted((r.q, r.place, r.t, round(r.distance, 9)) for r in neighbours.nearest(q, t, "q", "t", ["a", "b"], k).collect())
    want = []
    for i, x in enumerate(queries):
        d = np.sqrt(((table[:, 0] - x[0]) ** 2) + ((table[:, 1] - x[1]) ** 2))
        want += [(i, place + 1, int(j), round(float(d[j]), 9)) for place, j in enumerate(np.lexsort((np.arange(len(d)), d))[:k])]
    assert got == want
    assert neighbours.nearest(q, t.limit(0), "q", "t", ["a", "b"], k).count() == 0
    assert neighbours.nearest(q.limit(0), t, "q", "t", ["a", "b"], k).count() == 0


def test_what_was_fitted_is_used_for_new_rows(spark, tmp_path):
    old = spark.createDataFrame([(i, float(i), None if i == 3 else 2.0 * i) for i in range(9)], "k long, a double, b double")
    store = str(tmp_path / "fitted")
    first = {r.k: r for r in features.impute_scale_categorize(old, "k", store=store).collect()}
    new = spark.createDataFrame([(2, 2.0, None), (100, 4000.0, 1.0)], "k long, a double, b double")
    again = {r.k: r for r in features.impute_scale_categorize(new, "k", store=store).collect()}
    assert again[2].a == first[2].a and again[2].b == first[3].b and again[100].a > 1000


def test_columns_of_many_categories_are_drawn_by_their_shares(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(synthesis, "LISTED_CATEGORIES", 1000)
    rows = [("common", 1.0)] * 5000 + [(f"v{i}", 0.0) for i in range(5000)] + [(None, 0.5)] * 1000
    df = spark.createDataFrame(rows, "c string, x double")
    made = synthesis.run(df, ["c", "x"], 20_000, str(tmp_path))
    share = {r.c: r["count"] / 20_000 for r in made.groupBy("c").count().collect()}
    assert abs(share["common"] - 5 / 11) < 0.01 and abs(share[None] - 1 / 11) < 0.01 and len(share) > 3000 and made.count() == 20_000
    assert max(v for k, v in share.items() if k not in ("common", None)) < 0.002
    again = synthesis.load_copula(spark, str(tmp_path / "synth_GC"))
    assert again.metadata()["c"]["kind"] == "category" and 4500 < again.metadata()["c"]["distinct"] < 5500
    assert sorted(map(str, synthesis.sample_gaussian_copula(spark, again, 20_000).collect())) == sorted(map(str, made.collect()))


def test_synthesis_stage_converts_decimals_and_intervals(spark, tmp_path):
    df = spark.range(200).selectExpr("cast(id / 3.0 as decimal(10, 2)) as d", "make_dt_interval(cast(id % 30 as int), 5) as i", "id % 7 as n")
    made = synthesis.run(df, ["d", "i", "n"], 100, str(tmp_path))
    assert dict(made.dtypes) == {"id": "bigint", "d": "double", "i": "bigint", "n": "bigint"} and made.agg(F.max("i")).first()[0] <= 29


def test_attacks_tell_a_copy_from_noise(spark):
    rng = np.random.default_rng(5)
    real = spark.createDataFrame([(i, float(a), float(a + b / 10), "xyz"[i % 3]) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))], "id long, v double, w double, c string")
    noise = spark.createDataFrame([(i, float(a), float(b), "xyz"[int(k)]) for i, (a, b, k) in enumerate(np.c_[rng.normal(size=(200, 2)), rng.integers(0, 3, 200)])], "id long, v double, w double, c string")
    every = F.col("id") >= 0
    for made, low, high in ((real, 0.5, 1.0), (noise, -0.2, 0.2)):
        assert low <= privacy.inference(real, made, "id", ["v"], "w", every).first().risk <= high
        assert low <= privacy.linkability(real, made, "id", ["v"], ["w"], every, 3).first().risk <= high
    assert privacy.inference(real, real, "id", ["v", "w"], "c", every).first().rate == 1.0
    assert privacy.singling_out(real, real, ["v"]).first().rate == 1.0 and privacy.singling_out(real, noise, ["v"]).first().rate == 0.0


def test_stages_write_their_reports(spark, tmp_path):
    import json

    a = spark.createDataFrame([(i, float(i), float(i % 5), "xy"[i % 2], float(i)) for i in range(80)], "id long, v double, w double, c string, BMI double")
    report = audit.run(a, a, str(tmp_path), ["v", "c", "BMI"])
    assert {r["property"]: r["score"] for r in report["quality"]} == {"shape": 1.0, "trend": 1.0, "overall": 1.0}
    assert json.loads((tmp_path / "audit_report.json").read_text()).keys() == report.keys()
    made = privacy.run(a, a, "id", str(tmp_path))
    assert made["inference"]["v"]["risk"]["band"] == "high" and "mean_risk" in made["summary"][""] and made["numeric"]["v"]["p_value"] == 1.0
    assert json.loads((tmp_path / "privacy_report.json").read_text()) == made
    with pytest.raises(ValueError):
        audit.run(a.limit(0), a, str(tmp_path))


def test_blocks_are_copied_only_where_queries_come(spark, monkeypatch):
    """300 queries at one place: the other cells' points are sent once."""
    monkeypatch.setattr(neighbours, "BLOCK_POINTS", 10)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 50)
    copies, filled = [], neighbours.Cells.filled
    monkeypatch.setattr(neighbours.Cells, "filled", lambda self, *parts: copies.append(parts[2]) or filled(self, *parts))
    t = spark.range(200).selectExpr("id as t", "cast(id as double) as x")
    q = spark.range(300).selectExpr("id as q", "100 + id / 1000 as x")
    got = neighbours.nearest(q, t, "q", "t", ["x"])
    assert {(r.q, r.t) for r in got.collect()} == {(i, 100) for i in range(300)}
    assert max(copies[-1]) >= 6 and sorted(copies[-1])[len(copies[-1]) // 2] == 1


def test_a_quantile_among_equal_values_is_their_value(spark, monkeypatch):
    """Nothing that is equal to the quantile counts as below it, whatever the place between the ranks."""
    monkeypatch.setattr(stats, "EXACT_ROWS", 10)
    v = 0.9
    df = spark.range(44).select(F.lit(v).alias("x"))
    at = [p / 97 for p in range(1, 97)]
    assert stats.exact_quantiles(df, ["x"], at)["x"] == [v] * 96


def test_a_search_is_not_repeated_and_a_far_box_is_left_out():
    """Two cells whose balls overlap, the first of two blocks: a query goes to what is left of its own cell, and to the other one only if its box is near enough."""
    one = np.ones(2, np.int64)
    cells = neighbours.Cells.grown(np.array([[0.0, 0.0], [10.0, 0.0]])).filled(np.array([4.0, 9.0]), np.array([2, 1]), one)
    cells.low, cells.high = np.array([[-4.0, 0.0], [9.5, 0.0]]), np.array([[4.0, 0.0], [19.0, 0.0]])
    asked = {"x0": [3.9, 3.9, 3.9], "x1": [0.0, 0.0, 0.0], "cell": pa.array([0, 0, 0], pa.int32()), "block": pa.array([0, 1, 0], pa.int32()), "distances": pa.array([[1.0], [5.6], []], pa.list_(pa.float64()))}
    _, row, cell, block = neighbours._within(cells, pa.record_batch(asked), ["x0", "x1"], 1)
    assert sorted(zip(row.tolist(), cell.tolist(), block.tolist())) == [(0, 0, 1), (1, 0, 0), (1, 1, 0), (2, 0, 1), (2, 1, 0)]


def test_queries_are_dealt_without_null_lists():
    """Spark measures a batch after every row, and nulls at the end of a list column cost it a pass each time."""
    b = pa.record_batch({"x0": [1.0, 2.0]})
    zero = np.zeros(2, np.int64)
    for dealt in neighbours._dealt(b, ["x0"], np.arange(2), zero, zero, zero, True):
        assert dealt.num_rows == 2 and not any(c.null_count for c in dealt.columns)
