"""Operator 4 against brute force, and the recall of its buckets."""

import pickle
import random

import numpy as np
import pytest

from cohortloom.llm import decontaminate as dc

VOCABULARY = ["the", "of", "and", "to"] * 12 + [f"w{i}" for i in range(400)]


def _words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k, how = rng.randrange(len(words)), rng.randrange(3)
        if how == 0:
            words[k] = "zz" + str(rng.randrange(99))
        elif how == 1:
            del words[k]
        else:
            words.insert(k, "yy" + str(rng.randrange(99)))
    return words


def _brute(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_edit_distance_equals_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(5) for _ in range(rng.randrange(0, 14))]
        d, start, to = dc.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64))
        assert d == _brute(a, b)
        inner, row = b[start:to], list(range(len(b[start:to]) + 1))
        for i, w in enumerate(a, 1):
            new = [i]
            for j, x in enumerate(inner, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
            row = new
        assert row[-1] == d


def test_leaks_with_few_edits_are_found_and_nothing_else(spark):
    rng = random.Random(6)
    items = [_words(rng, n) for n in [15, 20, 30, 45, 57] * 12] + [["solo"], ["two", "words"], [], ["aa", "bb", "cc", "dd", "ee"]]
    rows, planted = [], set()
    for d in range(300):
        words = _words(rng, rng.randrange(20, 120))
        if d % 2:
            i = rng.randrange(60)
            k = rng.randrange(len(words))
            words[k:k] = _edited(rng, items[i], int(len(items[i]) * rng.choice([0, 0.05, 0.1, 0.15])))
        rows.append((d, ", ".join(words).upper() if d % 3 else "  ".join(words), 1))
        planted |= {(d, i) for i, w in enumerate(items) if w and _brute(w, words) <= int(0.25 * len(w) + 1e-9)}
    rows += [(900, None, 1), (901, "", 1), (902, "-- ..", 1), (903, "x solo y", 1), (904, "aa bb xx dd ee", 1), (903, "x solo y", 1), (None, "solo", 1)]
    planted |= {(903, 60), (904, 63), (None, 60)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(99, None)], "item_id long, text string")
    got = [tuple(r)[:3] for r in dc.find_leaks(docs, bench).collect()]
    found = {(d, i) for d, i, _ in got}
    assert not found - planted
    assert len(found & planted) / len(planted) > 0.97
    assert sum(d == 903 for d, _, _ in got) == 2
    text = {d: dc.Words(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]), plain=True).hash for d, t, _ in rows}
    block = dc.Items(list(range(len(items))), [" ".join(w) for w in items])
    assert all(_brute(block.words[i].tolist(), text[d].tolist()) == e for d, i, e in got)
    odd = bench.selectExpr("item_id", "text", "'x' as doc_id", "1 as n", "2 as similarity")
    assert sorted(map(str, dc.find_leaks(docs, odd).collect())) == sorted(map(str, dc.find_leaks(docs, bench).collect()))
    assert dc.find_leaks(docs.limit(0), bench).count() == 0 and dc.find_leaks(docs, bench.limit(0)).count() == 0


def test_every_copy_with_a_quarter_of_its_words_edited_is_found():
    rng = random.Random(12)
    for n in [1, 3, 5, 7, *range(8, 25), 30, 37, 45, 60]:
        items = [_words(rng, n) for _ in range(25)]
        texts = [_words(rng, 30) + _edited(rng, w, n // 4) + _words(rng, 30) for w in items]
        raw = [" ".join(t).encode() for t in texts]
        block = dc.Items(list(range(len(items))), [" ".join(w) for w in items])
        got = {(d, i): e for d, i, e, *_ in block.matches(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0.75)}
        least = {(d, i): _brute(w, t) for d, t in enumerate(texts) for i, w in enumerate(items)}
        assert got == {k: e for k, e in least.items() if e <= n // 4}


def test_walks_alone_find_most_copies_at_every_length():
    for n in [*range(8, 25), 30, 40, 60]:
        for edits in {1, n // 8, n // 4}:
            rng = random.Random(100 * n + edits)
            items = [_words(rng, n) for _ in range(40)]
            raw = [" ".join(_words(rng, 30) + _edited(rng, w, edits) + _words(rng, 30)).encode() for w in items]
            block = dc.Items(list(range(len(items))), [" ".join(w) for w in items])
            block.seeds = {}
            got = {(d, i) for d, i, *_ in block.matches(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0.75)}
            assert sum((i, i) in got for i in range(len(items))) >= 36, (n, edits)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [_words(rng, 20) for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(_words(rng, 30) + w)) for i, w in enumerate(items)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    whole = sorted(map(tuple, dc.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 7)
    assert sorted(map(tuple, dc.find_leaks(docs, bench).collect())) == whole and len(whole) >= 30


@pytest.mark.parametrize("words, least", [(130, 150_000), (12, 500_000)])
def test_a_full_block_of_items_stays_small(words, least):
    rng = random.Random(10)
    texts, size = [], 0
    while size < dc.BLOCK_BYTES and len(texts) < dc.BLOCK_ITEMS * 4:
        texts.append(" ".join(f"{rng.randrange(36**2):x}" for _ in range(words)))
        size += len(texts[-1])
    block = dc.Items(list(range(len(texts))), texts)
    assert block.anchors > least and len(pickle.dumps(block)) < (80 << 20 if words > 24 else 100 << 20)


def test_a_very_long_text(spark):
    rng = random.Random(9)
    item = _words(rng, 30)
    docs = spark.createDataFrame([(1, " ".join(_words(rng, 400_000) + item + _words(rng, 50)))], "doc_id long, text string")
    got = dc.find_leaks(docs, spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.edit_distance) for r in got] == [(1, 5, 0)]
