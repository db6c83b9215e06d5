"""Operator 10 against brute force."""

import os

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import embedding_dedup as ed
from cohortloom.llm.components import connected_components


def _brute(vectors: dict[int, list]):
    ids, unit = [], []
    for i, v in vectors.items():
        x = np.array(v, float) if v else np.zeros(1)
        if np.isfinite(x).all() and (x != 0).any():
            ids.append(i)
            unit.append(x / np.linalg.norm(x))
    unit = np.stack(unit)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    parent = {i: i for i in vectors}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        x, y = find(ids[a]), find(ids[b])
        parent[max(x, y)] = min(x, y)
    return dict(zip(ids, near.sum(axis=1))), {i: find(i) for i in vectors}


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 300)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, **{i: 200 for i in range(200, 203)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_table_with_all_edge_rows(spark):
    rng = np.random.default_rng(1)
    vectors = {}
    for i in range(0, 300, 3):
        v = rng.normal(size=16)
        vectors[i], vectors[i + 1], vectors[i + 2] = v.tolist(), (v + rng.normal(size=16) * 0.02).tolist(), (v * 3).tolist()
    hot = rng.normal(size=16)
    for i in range(400, 1100):
        vectors[i] = (hot + rng.normal(size=16) * rng.choice([0, 0.05])).tolist()
    odd = {2000: None, 2001: [], 2002: [0.0] * 16, 2003: [float("nan")] * 16, 2004: [1.0] * 15 + [None], 2005: [float("inf")] * 16, 2006: [1e-200] * 16, 2007: [1e200] * 16}
    rows = [(i, v, 1) for i, v in (vectors | odd).items()] + [(3000, [1.0, 2.0], 1), (3001, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: r for r in ed.near_duplicates(df).collect()}
    links, component = _brute(vectors)
    recall = sum(min(got[i].n_links, n) for i, n in links.items()) / sum(links.values())
    assert recall > 0.98 and all(got[i].n_links <= n for i, n in links.items())
    assert np.mean([got[i].component_id == c for i, c in component.items()]) > 0.98
    for i in list(odd)[:6]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[2007].component_id == 2006 and got[3001].component_id == 3000 and got[3001].n_links == 1
    assert ed.near_duplicates(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, ed.near_duplicates(df).collect()))
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_a_large_group_of_near_copies_loses_no_link(spark):
    n, rng = 21_000, np.random.default_rng(5)
    x = rng.normal(size=(n, 64))
    x[: n // 3] = rng.normal(size=64) + rng.normal(size=(n // 3, 64)) * 0.176  # cosine about 0.97
    x = x.astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)})).repartition(4)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.95).sum(axis=1) - 1 for i in range(0, n, 1000)])
    got = {r.vec_id: r.n_links for r in ed.near_duplicates(df).collect()}
    assert links.sum() > 40_000_000 and [got[i] for i in range(n)] == links.tolist()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the test tables")
def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {r.vec_id: r for r in ed.near_duplicates(df).collect()}
    links, component = _brute({r.vec_id: list(r.embedding) for r in df.collect()})
    assert sum(min(got[i].n_links, n) for i, n in links.items()) >= 0.95 * sum(links.values())
    assert all(got[i].n_links <= n for i, n in links.items())
    assert np.mean([got[i].component_id == c for i, c in component.items()]) > 0.99
