"""Operator 13 against a search of every period and place."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cohortloom.llm import periodic_runs


def all_runs(words):
    """(start, length, period) by comparing every pair of words one period apart."""
    best = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                best.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in best.items())


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = altered(doc_id, (text or "").encode().split())
    runs = all_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def texts():
    rng = random.Random(4)
    out = []
    for k in range(300):
        alphabet = ["a", "b", "é", "dd", "E", "e"][: rng.randrange(1, 7)]
        words = [rng.choice(alphabet) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            piece = [rng.choice(alphabet) for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = piece * rng.randrange(1, 12)
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t\r", "\x0b\x0c"]) for w in words))
    nest = (["a", "b"] * 13 + ["c"]) * 4
    return [*out, " ".join(nest), "x " * 24, "x " * 23, "a b c " * 8, "  " * 30, " x " * 40, "", None, " \n"]


@pytest.mark.parametrize("block, grid", [(100_000, 1 << 20), (50, 64)])
def test_runs_equal_those_of_every_period_and_place(spark, monkeypatch, block, grid):
    monkeypatch.setattr(periodic_runs, "BLOCK_WORDS", block)
    monkeypatch.setattr(periodic_runs, "GRID", grid)
    lines = [(t or "").split() for t in texts()]
    numbers = [np.unique(np.array(x or [""]), return_inverse=True)[1].astype(np.int64)[: len(x)] for x in lines]
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
    got = periodic_runs.find_runs(np.concatenate(numbers), ptr)
    assert [tuple(r) for r in got.tolist()] == [(d, *r) for d, x in enumerate(lines) for r in all_runs(x)]
    rows = list(enumerate(texts())) + [(3, texts()[3]), (5, "x y " * 20)]
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, runs int, h int")
    got = sorted((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in periodic_runs.run_digests(df).collect())
    assert got == sorted((i, *expected(i, t)) for i, t in rows)
    assert sum(r[1] for r in got) > 100


def test_rows_at_the_edges(spark):
    none = hashlib.sha256(b"").hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.run_digests(empty).collect() == []
    rows = {r.doc_id: r for r in periodic_runs.run_digests(spark.createDataFrame([(None, "p q " * 30), (1, None)], "doc_id long, text string")).collect()}
    assert (rows[None].n_runs, rows[None].start, rows[None].length, rows[None].period, rows[None].exponent_milli) == (1, 0, 60, 2, 30000)
    assert rows[None].collapsed_sha256 == hashlib.sha256(b"p q").hexdigest()
    assert rows[1].n_runs == 0 and rows[1].start is None and rows[1].runs_sha256 == rows[1].collapsed_sha256 == none


def test_a_very_long_text(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(5000)}" for _ in range(150_000)]
    piece = [f"v{rng.randrange(50)}" for _ in range(700)]
    text = " ".join(words + piece * 20 + words[:50_000])
    df = spark.createDataFrame([(2, text)], "doc_id long, text string")
    assert zlib.crc32(b"2") % 10
    row = periodic_runs.periodic_runs(df).first()
    assert [tuple(r) for r in row.runs] == [(150_000, 14_000, 700)] and tuple(row.best) == (150_000, 14_000, 700)
    assert row.collapsed == " ".join(words + piece + words[:50_000]) and row.words == 214_000
