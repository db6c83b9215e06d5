"""Operator 9 against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import jaccard_join as jj
from cohortloom.llm.arrowtext import Words


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def _brute(rows):
    ids, sets = [r[0] for r in rows], [_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for t in s:
            where.setdefault(t, []).append(i)
    for i, s in enumerate(sets):
        seen = {j for t in s for j in where[t] if j > i}
        for j in seen:
            both = len(s & sets[j])
            if 100 * both >= 75 * len(s | sets[j]):
                parent[find(j)] = find(i)
    low = {}
    for i in range(len(rows)):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return sorted((ids[i], len(sets[i]), low[find(i)]) for i in range(len(rows)))


def _corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(60)] + ["Ä", "Éa", "x,"]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(n):
        how = rng.random()
        if texts and how < 0.45:
            words = rng.choice(texts[-40:]).split()
            for _ in range(rng.randrange(0, 4)):
                if words:
                    k = rng.randrange(len(words))
                    words[k : k + rng.randrange(0, 2)] = [rng.choice(vocabulary)]
        elif how < 0.6:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 9))] + passage + [rng.choice(vocabulary) for _ in range(rng.randrange(3, 9))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 8, 20, 40, 80]))]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jj, "SAMPLE_DOCS", 100 if seed == 2 else 8000)
    rng = random.Random(seed)
    rows = [(i, t if rng.random() < 0.8 else t.upper(), 1) for i, t in enumerate(_corpus(rng, 600))]
    rows += [(5000 + i, "one long text that was copied many times over and over again", 1) for i in range(300)]
    rows += [(9000, None, 1), (9001, "", 1), (9002, " \n", 1), (9003, "Ä b", 1), (9004, "ä b", 1), (9005, "A b", 1), (9006, "a\tB", 1), (9007, "w " * 200_000, 1)]
    rows += rows[:20] + [(3, "another text under the same id as before", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int")
    got = sorted(tuple(r)[:3] for r in jj.link_groups(df.repartition(6)).collect())
    want = _brute(rows)
    assert got == want


def test_one_of_each_group_stays(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(5, a, "x"), (4, a.upper(), "y"), (4, b, "z"), (4, b, "z"), (6, None, "n"), (6, None, "n"), (7, "", "e"), (None, "lone words here", "q"), (9, b + " fourteen and more of it", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    got = sorted(map(tuple, jj.keep_one_of_each_group(df).collect()), key=str)
    assert got == sorted([rows[1], rows[2], *rows[4:]], key=str)
    assert jj.keep_one_of_each_group(df.limit(0)).count() == 0


def test_null_ids_among_copies(spark):
    rng = random.Random(11)
    rows = []
    for family in range(12):
        words = [f"f{family}w{i}" for i in range(40)]
        for k in range(6):
            edited = list(words)
            if k % 3:
                edited[rng.randrange(40)] = f"x{k}"
            null = family % 4 == 3 or (family % 4 and k % 2 == family % 2)
            rows.append((None if null else 100 * family + k, " ".join(edited), family))
    df = spark.createDataFrame(rows, "doc_id long, text string, family int")
    got = jj.link_groups(df).collect()
    low = {f: min((d for d, _, g in rows if g == f and d is not None), default=None) for f in range(12)}
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == sorted((str(d), str(low[f])) for d, _, f in rows)
    assert len({r.group_id for r in got}) == 12
    kept = jj.keep_one_of_each_group(df).collect()
    assert sorted((r.family, r.doc_id) for r in kept if r.doc_id is not None) == [(f, d) for f, d in low.items() if d is not None]
    assert sorted(r.family for r in kept) == list(range(12))


def test_empty_table(spark):
    assert jj.link_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_across_batches():
    rng = np.random.default_rng(2)
    for cut in (1, 2, 3, 7, 50):
        token = np.sort(rng.integers(0, 30, 200))
        cls = rng.integers(0, 6, 200)
        order = np.lexsort((cls, token))
        rows = {"token": token[order], "class": cls[order], "n": np.ones(200, np.int64), "pos": np.zeros(200, np.int32)}
        batches = [pa.RecordBatch.from_pydict({k: v[i : i + cut] for k, v in rows.items()}) for i in range(0, 200, cut)]
        got = pa.Table.from_batches(list(jj._shared_tokens(iter(batches)))).to_pylist()
        pairs = {(r["token"], r["class"]) for r in got}
        several = {t for t in token if len(set(cls[order][token[order] == t])) > 1}
        assert pairs == {(t, c) for t, c in zip(token[order], cls[order]) if t in several}
        assert all(r["hub"] == min(cls[order][token[order] == r["token"]]) for r in got)


def test_words_equal_the_pattern():
    rng = random.Random(7)
    texts = ["".join(rng.choice("aB \t\n\x0b\x0c\réÄ\xa0\x85z") for _ in range(rng.randrange(0, 30))) for _ in range(500)]
    raw = [t.encode() for t in texts]
    w = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    names = {}
    for d, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        own = w.hash[w.ptr[d] : w.ptr[d + 1]].tolist()
        assert len(own) == len(words)
        for h, x in zip(own, words):
            assert names.setdefault(x, h) == h
    assert len(set(names.values())) == len(names)
