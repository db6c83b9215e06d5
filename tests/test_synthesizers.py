"""The mixture and the dependency tree: what they recover, keep exactly and draw again."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.plans import mixture, synthesis, tree
from cohortloom.plans.synthesis import _uniform, to_normal


@pytest.fixture(scope="module")
def clusters(spark):
    """Three clusters; a number is missing in the third only, a category goes with the cluster, another has 3000 values."""

    def rows(batches):
        import pandas as pd

        for b in batches:
            ids = b["id"].to_numpy()
            k = np.searchsorted([0.5, 0.8], _uniform(ids, 1, 0), "right")
            x = np.array([0.0, 10, 30])[k] + to_normal(_uniform(ids, 1, 1))
            y = np.array([5.0, -5, 0])[k] + 2 * to_normal(_uniform(ids, 1, 2))
            y[(k == 2) & (_uniform(ids, 1, 3) < 0.5)] = np.nan
            yield pd.DataFrame({"id": ids, "x": x, "y": y, "whole": np.rint(x).astype(int), "kind": np.array(["a", "b", None], object)[k], "many": [f"v{int(3000 * u * u)}" for u in _uniform(ids, 1, 4)]})

    return spark.range(0, 12_000, 1, 5).mapInPandas(rows, "id long, x double, y double, whole int, kind string, many string").persist()


def test_the_mixture_finds_the_clusters(spark, clusters, tmp_path):
    model = mixture.fit_mixture(clusters, ["x", "y", "kind"], 3)
    at = np.argsort(model.component_means()[:, 0])
    np.testing.assert_allclose(model.component_means()[at], [[0, 5], [10, -5], [30, 0]], atol=0.15)
    np.testing.assert_allclose(model.weight[at], [0.5, 0.3, 0.2], atol=0.02)
    np.testing.assert_allclose(model.known[at, 1], [1, 1, 0.5], atol=0.04)
    np.testing.assert_allclose(np.sqrt(model.variance[at]) * np.array([n[3] for n in model.numbers]), [[1, 2]] * 3, atol=0.15)
    assert all(b > a - 1e-9 for a, b in zip(model.likelihood, model.likelihood[1:]))
    # what a step of expectation maximisation keeps exactly: means and shares of the whole
    row = clusters.agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg(F.col("kind").isNull().cast("int")).alias("none")).first()
    weighed = model.weight[:, None] * model.known
    np.testing.assert_allclose((weighed * model.component_means()).sum(axis=0) / weighed.sum(axis=0), [row.x, row.y], rtol=1e-9)
    assert model.weight @ model.chances[0][:, -1] == pytest.approx(row.none)
    model.save(spark, str(tmp_path))
    again = mixture.load_mixture(spark, str(tmp_path))
    a, b = (mixture.sample_mixture(spark, m, 5000, 3).collect() for m in (model, again))
    assert a == b and len(a) == 5000
    assert a == sorted(mixture.sample_mixture(spark, model, 5000, 3).repartition(3).collect())
    by = {k: [r for r in a if r.kind == k] for k in ("a", "b", None)}
    assert [len(by[k]) / 5000 for k in by] == pytest.approx([0.5, 0.3, 0.2], abs=0.02)
    assert np.mean([r.x for r in by["b"]]) == pytest.approx(10, abs=0.2) and np.mean([r.y is None for r in by[None]]) == pytest.approx(0.5, abs=0.05)


def test_the_tree_keeps_the_shares_of_pairs(spark, clusters, tmp_path):
    columns = ["kind", "whole", "y", "many"]
    model = tree.fit_tree(clusters, columns)
    assert model.parent[columns.index("whole")] == columns.index("kind") and model.information["kind", "whole"] > 0.9
    assert model.information["kind", "many"] < 0.02
    made = tree.sample_tree(spark, model, 12_000, 9).persist()
    assert made.collect() == tree.sample_tree(spark, model, 12_000, 9).collect()
    assert sorted(made.select("id", "many").collect()) == sorted(tree.sample_tree(spark, model, 12_000, 9).repartition(7).select("id", "many").collect())
    pair = lambda df: Counter((r.kind, None if r.whole is None else r.whole // 4) for r in df.collect())
    a, b = pair(clusters), pair(made)
    assert max(abs(a[k] - b[k]) for k in a | b) < 0.02 * 12_000
    missing = lambda df: df.agg(F.avg((F.col("y").isNull() & F.col("kind").isNull()).cast("int")), F.avg(F.col("y").isNull().cast("int"))).first()
    assert list(missing(made)) == pytest.approx(list(missing(clusters)), abs=0.02)
    seen = {r.many for r in clusters.select("many").distinct().collect()}
    drawn = Counter(r.many for r in made.collect())
    assert set(drawn) <= seen and len(drawn) > 1000
    model.save(spark, str(tmp_path))
    assert tree.sample_tree(spark, tree.load_tree(spark, str(tmp_path)), 300, 9).collect() == tree.sample_tree(spark, model, 300, 9).collect()


@pytest.mark.parametrize("kind", ["GC", "mixture", "tree"])
def test_tables_at_the_edges(spark, kind, tmp_path):
    none = spark.createDataFrame([(1, None, None, 2.0, "one"), (2, None, None, 2.0, "one")], "id int, nothing double, empty string, constant double, word string")
    for columns in (["nothing", "empty", "constant", "word"], ["word"]):
        rows = synthesis.synthesize(none, columns, 20, kind).collect()
        assert len(rows) == 20 and {r.word for r in rows} == {"one"}
        if len(columns) > 1:
            assert {(r.nothing, r.empty, r.constant) for r in rows} == {(None, None, 2.0)}
    if kind != "GC":
        assert {tuple(r)[1:] for r in synthesis.synthesize(none.limit(0), ["nothing", "word"], 5, kind).collect()} == {(None, None)}
    made = synthesis.run(none, ["constant", "word"], 7, str(tmp_path), kind)
    assert made.count() == 7 and (tmp_path / f"synth_{kind}/metadata.json").exists()


def test_slots_of_the_registry(spark, clusters):
    assert {"GC", "TVAE", "RTF", "mixture", "tree"} <= set(synthesis.SYNTHESIZERS) or synthesis.synthesizer("RTF")
    for kind in ("TVAE", "RTF"):
        assert synthesis.synthesize(clusters.limit(500), ["x", "kind"], 10, kind).count() == 10
    with pytest.raises(ValueError, match="no synthesizer"):
        synthesis.synthesize(clusters, ["x"], 5, "CTGAN")


def test_mutual_information_of_known_tables(spark):
    rows = spark.createDataFrame([(a, a, b) for a in range(2) for b in range(5) for _ in range(3)], "s0 int, s1 int, s2 int")
    found = {r.pair: r.information for r in tree.mutual_information(tree.pair_counts(rows, ["s0", "s1", "s2"])).collect()}
    assert found[0] == pytest.approx(np.log(2)) and found[1] == pytest.approx(0) and found[2] == pytest.approx(0)


def test_rounds_of_the_mixture_read_packed_blocks(spark, clusters, monkeypatch):
    """Weighing equals the plain formula, and a round takes few blocks instead of a row of Spark each."""
    sizes, plain = [], mixture.summed
    monkeypatch.setattr(mixture, "summed", lambda rows, *more: sizes.append(rows.count()) or plain(rows, *more))
    monkeypatch.setattr(mixture, "CHUNK_ROWS", 100)
    model = mixture.fit_mixture(clusters, ["x", "y", "kind"], 3, 2)
    assert len(sizes) == 2 and 1 < sizes[0] < 12_000 / 50
    rows = clusters.select("x", "y", "kind").collect()
    known = [[None if v is None or np.isnan(v) else (v - n[2]) / n[3] for n, v in zip(model.numbers, r)] for r in rows]
    at = [len(model.categories[0][2]) if r.kind is None else model.categories[0][2].index(r.kind) for r in rows]
    normal = lambda v, m, s: np.exp(-((v - m) ** 2) / (2 * s)) / np.sqrt(2 * np.pi * s)
    chance = lambda r, a, k: model.weight[k] * max(model.chances[0][k, a], 1e-12) * np.prod([max(1 - model.known[k, j], 1e-12) if v is None else model.known[k, j] * normal(v, model.mean[k, j], model.variance[k, j]) for j, v in enumerate(r)])
    each = np.array([[chance(r, a, k) for k in range(3)] for r, a in zip(known, at)])
    share = each / each.sum(axis=1, keepdims=True)
    sums = []
    monkeypatch.setattr(mixture, "summed", lambda *more: sums.append(plain(*more)) or sums[-1])
    monkeypatch.setattr(mixture, "_start", lambda *_: model)
    mixture.fit_mixture(clusters, ["x", "y", "kind"], 3, 1)
    assert sums[0][0] == pytest.approx(np.log(each.sum(axis=1)).sum())
    np.testing.assert_allclose(sums[0][1:4], share.sum(axis=0))
    x = np.array([[0 if v is None else v for v in r] for r in known])
    np.testing.assert_allclose(sums[0][10:16].reshape(3, 2), share.T @ x, rtol=1e-7, atol=1e-7)


def test_the_shares_of_the_copula_are_those_of_drawn_rows_too(spark, monkeypatch, tmp_path):
    """The query draws from the model: drawn rows without a category are seen."""
    from cohortloom.queries import QUERIES

    spark.createDataFrame([(float(i % 7), "abbb"[i % 4]) for i in range(400)], "l_quantity double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = lambda: {(r.value, r.share, r.near) for r in QUERIES["copula_shares"](spark, str(tmp_path)).collect()}
    assert rows() == {("a", 0.25, True), ("b", 0.75, True)}
    draw = synthesis.sample_gaussian_copula
    monkeypatch.setattr(synthesis, "sample_gaussian_copula", lambda *more: draw(*more).where("l_returnflag = 'b'"))
    assert rows() == {("a", 0.25, False), ("b", 0.75, False)}
