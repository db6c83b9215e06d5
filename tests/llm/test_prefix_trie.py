"""Operator 12 against a trie of plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cohortloom.llm import prefix_trie


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(v)] for c, v in talks.items()}
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = talks.get(c - c % 5, [])[:h] + own[h:]
    return out


def trie(talks):
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((min(w), len(p), min(members[p[:-1]]) if p else -1, len(w), kids[p], leaves[p], saved[p], sha(",".join(map(str, sorted(c for c in w if len(talks[c]) == len(p)))))) for p, w in members.items())


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


SCHEMA = "conv_id long, turn int, role string, text string"


def talks(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        first = rng.randrange(3)
        for t in range(rng.randrange(1, longest)):
            rows.append((c * rng.choice([1, 1, 1, 7]) if seed % 2 else c, t, ["user", "assistant", None][rng.randrange(3) if t > 4 else t % 2], ["", "hi", "é" * 40, None, f"a{rng.randrange(4)}"][(first + t) % 5 if rng.random() < 0.7 else rng.randrange(5)]))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, longest, ranges", [(0, 200, 9, 13), (1, 90, 30, 4), (2, 400, 4, 60), (3, 60, 12, 1), (4, 25, 90, 25)])
def test_nodes_equal_those_of_a_plain_trie(spark, monkeypatch, seed, convs, longest, ranges):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    monkeypatch.setattr(prefix_trie, "OUT_ROWS", 7)
    rows = talks(seed, convs, longest)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert got(prefix_trie.prefix_nodes(prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == trie(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_conversations_and_first_turns(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(400) for t in range(12)] + [(1000 + c, t, "user", "same 0" if t == 0 else f"{c} {t}") for c in range(300) for t in range(3)]
    own = {c: [(r[2], r[3]) for r in rows if r[0] == c] for c in {r[0] for r in rows}}
    assert got(prefix_trie.prefix_nodes(prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA)))) == trie(own)


def test_rows_at_the_edges(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert got(prefix_trie.prefix_nodes(prefix_trie.rebuilt(nothing))) == []
    # no conv_id, nulls, ties, repeated rows, a clashing column, a very long text; 3 and 4 have no conversation 0 to start with
    rows = [(None, 0, "user", "x"), (3, None, None, None), (3, 0, "user", "b"), (3, 0, "user", "b"), (4, 1, "user", "z" * 2_000_000), (4, 1, "tool", "z"), (-3, 2, "user", "q"), (12, 5, "user", "p")]
    df = spark.createDataFrame([(*r, 5, "y") for r in rows], SCHEMA + ", node int, keys string")
    assert got(prefix_trie.prefix_nodes(prefix_trie.rebuilt(df))) == trie(rebuilt(rows))
    # a conversation without turns of its own is a member of the root
    only = [(7, 0, "user", "gone")]
    assert zlib.crc32(b"7") % 9 > 0 and got(prefix_trie.prefix_nodes(prefix_trie.rebuilt(spark.createDataFrame(only, SCHEMA)))) == [(7, 0, -1, 1, 0, 1, 0, sha("7"))]
