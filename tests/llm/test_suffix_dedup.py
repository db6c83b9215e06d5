"""Operator 11 against a set of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cohortloom.llm import suffix_dedup


def expected(rows, length=100):
    """Rows (doc_id, text) in the order in which they come first -> n_bytes, n_removed, n_spans and hash of each."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(data[i : i + length])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    line = "All rights reserved, and this line is in every third text of them, sixty to ninety bytes."
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(20, 60))) for _ in range(6)]
    out = []
    for k in range(n):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 160)))
        if k % 3 == 0:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + line + text[at:]
        if k % 2 == 0:
            at, p = rng.randrange(len(text) + 1), rng.choice(passages)
            text = text[:at] + p[rng.randrange(10) :] + text[at:]
        if k % 7 == 0 and out:
            text = rng.choice(out)
        if k % 11 == 0 and out:
            words = rng.choice(out).split(" ")
            words[rng.randrange(len(words))] = "EDIT"
            text = " ".join(words)
        if k % 17 == 0:
            text += "-" * rng.randrange(90, 1500)
        if k % 19 == 0:
            text += ("ab,cd " * 60) + "x" + ("ab,cd " * 30)
        if k % 23 == 0:
            text = (" ".join(rng.choice(vocabulary) for _ in range(9)) + "\n") * rng.randrange(2, 9)  # repeats in itself alone
        out.append(text)
    return out


def got(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


SETTINGS = [{}, {"MOST_SEGMENTS": 3, "CHUNK_BYTES": 700}, {"INDEX_BYTES": 1, "MOST_SEGMENTS": 50}, {"MOST_SEGMENTS": 0, "OUT_ROWS": 2}]


@pytest.mark.parametrize("seed, settings", list(enumerate(SETTINGS)))
def test_removed_bytes_equal_those_of_all_windows(spark, monkeypatch, seed, settings):
    for name, value in settings.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, at int, anchor int")
    want = expected(sorted(rows))
    assert got(suffix_dedup.repeat_digests(df)) == sorted(want)
    assert sum(r[2] for r in want) > 5000 and sum(r[3] for r in want) > 30


def test_all_of_it_comes_through_the_index(spark, monkeypatch):
    """Without matches of the index, windows that different segments share stay."""
    rows = list(enumerate(texts(1)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sum(r[2] for r in got(suffix_dedup.repeat_digests(df)))
    monkeypatch.setattr(suffix_dedup, "first_windows", lambda data, ends, length: np.flatnonzero(np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(data)) >= length))
    assert sum(r[2] for r in got(suffix_dedup.repeat_digests(df))) < whole - 1000


def test_rows_at_the_edges(spark):
    assert got(suffix_dedup.repeat_digests(spark.createDataFrame([], "doc_id long, text string"))) == []
    a, b = "".join(random.Random(1).choice("xyz ") for _ in range(150)), "short text"
    rows = [(None, a), (1, a), (2, None), (3, ""), (4, b), (4, b), (5, a[:120] + "!"), (6, a + a), (6, a + a), (6, a + a), (7, a + "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(expected(rows))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeat_digests(df).collect()) == want


@pytest.mark.parametrize("period", [1, 7, 31, 50, 68, 69, 70, 100, 101, 150])
def test_one_text_that_repeats_in_itself(period):
    rng = random.Random(period)
    text = bytes(rng.choice(b"abcdefgh") for _ in range(period)) * (600 // period)
    s = suffix_dedup.Segments(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 100)
    seen: dict[bytes, set] = {}
    for k, (place, windows) in enumerate(zip(s.place.tolist(), s.windows.tolist())):
        for i in range(place, place + windows):
            seen.setdefault(text[i : i + 100], set()).add((k, int(s.anchor[k])))
    assert s.windows.sum() == len(text) - 99
    for i in range(len(text) - 99):
        copies = sum(text[j : j + 100] == text[i : i + 100] for j in range(len(text) - 99))
        assert len(seen[text[i : i + 100]]) == copies and len({a for _, a in seen[text[i : i + 100]]}) == 1


def test_a_very_long_text(spark):
    rng = np.random.default_rng(3)
    body = rng.integers(97, 123, 2_500_000, dtype=np.uint8).tobytes().decode()
    rows = [(1, body), (2, body[1_000_000:1_100_000] + "#" + body[2_000_000:2_000_500])]
    made = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert made[1].spans == [] and bytes(made[1].kept).decode() == body
    assert [tuple(s) for s in made[2].spans] == [(0, 100_000), (100_001, 100_501)] and bytes(made[2].kept) == b"#"


def test_the_index_keeps_runs_and_streams_exact_matches():
    rng = random.Random(5)
    base = [rng.choice(b"ab") for _ in range(400)]
    strings = []
    for _ in range(20):
        s = list(base)
        s[rng.randrange(400)] = ord("c")
        strings.append(bytes(s))
    data, ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings])
    index = suffix_dedup.RunIndex(data, ends)
    assert index.sizes.sum() == len(data) and len(index.heads) < len(data) // 3
    length, other = index.statistics()
    tails = [s[i:] for s in strings for i in range(len(s))]
    order = sorted(range(len(tails)), key=lambda i: (tails[i], i))
    for i, j in zip(order, order[1:]):
        same = next((k for k, (x, y) in enumerate(zip(tails[i], tails[j])) if x != y), min(len(tails[i]), len(tails[j])))
        assert (length[j], other[j]) == (same, i)


def test_an_index_of_usual_size_sorts_packed_numbers(monkeypatch):
    rng = random.Random(4)
    phrase = bytes(rng.choice(b"abcd") for _ in range(200))
    strings = [phrase[rng.randrange(40) :] + bytes([97 + k % 3]) * rng.randrange(1, 30) for k in range(40)]
    data, ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(x) for x in strings])
    ordered, plain = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *args, **more: ordered.append(len(x)) or plain(x, *args, **more))
    found = suffix_dedup.first_windows(data, ends, 50).tolist()
    assert len(data) not in ordered
    seen, wanted, start = set(), [], 0
    for x in strings:
        for i in range(len(x) - 49):
            if x[i : i + 50] not in seen:
                seen.add(x[i : i + 50])
                wanted.append(start + i)
        start += len(x)
    assert found == wanted
