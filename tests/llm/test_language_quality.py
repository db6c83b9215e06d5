"""Operators 1 and 6: held-out accuracy and edge cases."""

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import language_id, quality_mil

DATA = "/root/testdata/sf0.01"


def test_backoff_uses_shorter_grams_for_unseen_words(spark):
    rows = [(i, t, l) for i in range(40) for t, l in (("the house and the garden", "en"), ("das haus und der garten", "de"))]
    model = language_id.fit(spark.createDataFrame([(2 * i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string"))
    s = language_id.Scorer(model)
    got = s.predict(["the the and", "houses", "haushaus", "zq", None, "12 ²³ $$", "", "haus " * 500_000])
    assert [x for x, _ in got[:3]] == ["en", "en", "de"] and got[3][0] in ("en", "de")
    assert got[4:7] == [("und", 0.0)] * 3
    assert got[7][0] == "de" and 0 <= got[7][1] <= 1


def _plain_predict(counts, languages, text):
    """The method over dictionaries of counts by kind, token and language, one word at a time."""

    def frequencies(kind, token):
        total = [sum(c[l] for c in counts[kind].values()) + 0.5 * len(counts[kind]) for l in languages]
        return [math.log((counts[kind][token][l] + 0.5) / t) for l, t in zip(languages, total)]

    def word_score(w):
        if w in counts[0]:
            return frequencies(0, w)
        marked = f"^{w}$"
        for n in range(5, 0, -1):
            grams = [marked[i : i + n] for i in range(len(marked) - n + 1)]
            known = [g for g in grams if g in counts[n]]
            if known and (2 * len(known) >= len(grams) or n == 1):
                return [sum(x) / len(known) for x in zip(*(frequencies(n, g) for g in known))]
        return [0.0] * len(languages)

    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    words = [w for w in words if any(map(str.isalpha, w))]
    if not words or not languages:
        return "und", 0.0
    mean = [sum(x) / len(words) for x in zip(*map(word_score, words))]
    odds = [math.exp((m - max(mean)) * min(len(words), 20)) for m in mean]
    best = max(range(len(languages)), key=lambda k: (mean[k], -k))
    return languages[best], odds[best] / sum(odds)


def test_predictions_equal_a_brute_force(spark):
    rng = random.Random(4)
    alphabets = {"aa": "abcdefgö", "bb": "efghijé", "cc": "aeioußм漢"}
    word = lambda l: "".join(rng.choice(alphabets[l]) for _ in range(rng.randrange(1, 7)))
    known = {l: [word(l) for _ in range(60)] for l in alphabets}
    rows = []
    for i in range(300):
        l = rng.choice(list(alphabets))
        rows.append((i, " ".join(rng.choice(known[l]) if rng.random() < 0.8 else word(l).upper() for _ in range(rng.randrange(0, 30))) + rng.choice(["", " 12,²", "."]), rng.choice([l, l, l, l, None])))
    rows += [(300, None, "aa"), (300, "abc", "aa"), (300, "abc", "aa"), (None, "efg", "bb"), (301, "", None)]
    counts = [collections.defaultdict(collections.Counter) for _ in range(6)]
    for i, text, l in rows:
        if l and zlib.crc32(str("" if i is None else i).encode()) % 3 != 1:
            for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
                if any(map(str.isalpha, w)):
                    counts[0][w][l] += 1
                    for n in range(1, 6):
                        for k in range(len(w) + 3 - n):
                            counts[n][f"^{w}$"[k : k + n]][l] += 1
    counts = [{t: c for t, c in kind.items() if sum(c.values()) >= 2} for kind in counts]
    got = language_id.evaluate(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    made = sorted(((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.score) for r in got.collect()))
    want = sorted(((i is None, i or 0, *_plain_predict(counts, sorted(alphabets), t)) for i, t, _ in rows))
    assert len(made) == len(want)
    for a, b in zip(made, want):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-4, (a, b)


def test_every_language_and_word_of_the_sample_is_known(spark):
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}q zz", f"l{i:04d}") for i in range(1200) for _ in range(2)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 1200 and len(model.keys[0]) == 1201
    got = language_id.Scorer(model).predict([t for _, t, _ in rows[::100]])
    assert [x for x, _ in got] == [l for _, _, l in rows[::100]]


def test_language_edge_rows(spark):
    docs = spark.createDataFrame([(1, "the a", "en", 1), (1, "the a", "en", 1), (2, None, None, 1), (None, "the", "en", 1), (4, "x", None, 1)], "doc_id long, text string, lang string, score int")
    got = language_id.evaluate(docs).collect()
    assert len(got) == 5 and {r.lang_pred for r in got if r.doc_id == 2} == {"und"}
    assert language_id.evaluate(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in language_id.evaluate(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language_id.evaluate(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.98


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(k, quality_mil.FEATURES)) for k in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0])
    net = quality_mil.train(bags, y, epochs=1)
    x, size = np.concatenate(bags), np.array([1, 3, 2])
    ptr, bag = np.array([0, 1, 4, 6]), np.repeat(np.arange(3), size)

    def loss():
        p = net.forward(x, ptr)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    f = net.forward(x, ptr)
    grad = quality_mil.gradients(net.w, f, bag, (f["p"] - y) / 3)
    for k, at in (("enc", (4, 3)), ("att", (2, 5)), ("gate", (7, 1)), ("att_out", (3,)), ("out", (9,))):
        before, step = net.w[k][at], 1e-5
        net.w[k][at] = before + step
        up = loss()
        net.w[k][at] = before - step
        down = loss()
        net.w[k][at] = before
        assert abs((up - down) / (2 * step) - grad[k][at]) < 1e-6


def test_passages_cover_whole_texts_one_by_one():
    rng = random.Random(2)
    texts = ["", "a b", "x " * 64, "x " * 65, "  \n", " ".join(rng.choice(["aa", "B!", "é", "1", "##"]) for _ in range(500))]
    raw = [t.encode() for t in texts]
    together = quality_mil.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.diff(together[1]).tolist() == [1, 1, 1, 2, 1, 8]
    for i, r in enumerate(raw):
        x, ptr = quality_mil.encode(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert np.allclose(x, together[0][together[1][i] : together[1][i + 1]], atol=1e-6)


def test_quality_edge_rows(spark):
    good, bad = "plain words in a sentence. ", "BAD!! WORDS!! HERE!! "
    docs = spark.createDataFrame([(i, (good if i % 2 else bad) * (1 + i % 5), 1) for i in range(200)] + [(7, good, 1), (None, None, 1), (900, "", 1), (901, good * 40_000, 1)], "doc_id long, text string, predicted int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, None), (None, 1), (5000, 0), (7, 1)], "doc_id long, quality int")
    got = quality_mil.evaluate(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 200]) > 0.95
    assert quality_mil.evaluate(docs.limit(0), labels).count() == 0
    same = quality_mil.evaluate(docs, labels.withColumns({"text": F.lit("x"), "score": F.lit(1), "bag": F.lit(2), "chance": F.lit(3)})).collect()
    assert sorted(map(str, same)) == sorted(map(str, got))
    assert {r.score for r in quality_mil.evaluate(docs, labels.limit(0)).collect()} == {0.5}


def _plain_score(net, text):
    """The network over one text, one passage and one number at a time."""
    w = net.w
    words = text.encode().split(b" ")
    passages = [words[i : i + quality_mil.PASSAGE_WORDS] for i in range(0, len(words), quality_mil.PASSAGE_WORDS)]
    raw = [b"".join(x + b" " for x in p) for p in passages[:-1]] + [b" ".join(passages[-1])]
    hidden, logits = [], []
    for r in raw:
        x = quality_mil.encode(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0][0]
        x = [max(-6.0, min(6.0, (float(v) - m) / s)) for v, m, s in zip(x, net.mean, net.scale)]
        x = [v * (quality_mil.HASHED_WEIGHT if k >= quality_mil.SHAPE else 1) for k, v in enumerate(x)]
        h = [math.tanh(sum(v * w["enc"][k, j] for k, v in enumerate(x)) + w["enc_b"][j]) for j in range(quality_mil.HIDDEN)]
        t = [math.tanh(sum(v * w["att"][k, j] for k, v in enumerate(h))) for j in range(quality_mil.ATTENTION)]
        g = [1 / (1 + math.exp(-sum(v * w["gate"][k, j] for k, v in enumerate(h)))) for j in range(quality_mil.ATTENTION)]
        hidden.append(h)
        logits.append(sum(a * b * c for a, b, c in zip(t, g, w["att_out"])))
    e = [math.exp(x - max(logits)) for x in logits]
    z = [sum(a * h[j] for a, h in zip(e, hidden)) / sum(e) for j in range(quality_mil.HIDDEN)]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, w["out"])) + float(w["out_b"]))))


def test_scores_equal_a_brute_force(spark):
    rng = random.Random(8)
    word = lambda good: rng.choice(["plain", "words", "in", "a", "sentence."] if good else ["BAD!!", "W0RDS", "###", "buy", "||"])
    texts = [" ".join(word(rng.random() < (0.9 if i % 2 else 0.2)) for _ in range(rng.choice([1, 5, 63, 64, 65, 200]))) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    net = quality_mil.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int"))
    got = {r.doc_id: r.score for r in quality_mil.score(docs, net).collect()}
    assert max(abs(got[i] - _plain_score(net, t)) for i, t in enumerate(texts)) < 1e-4


def test_what_is_learned_from_is_bounded_after_the_join(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_mil, "train", lambda bags, labels: seen.append(bags))
    docs = spark.createDataFrame([(3, f"w{i} x") for i in range(3000)] + [(4, "long " * 200_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    quality_mil.fit(docs, labels, 400, 1000)
    assert 300 < len(seen[0]) < 600 and max(map(len, seen[0])) <= quality_mil.BAG_PASSAGES
    quality_mil.fit(docs, labels, 6000, 200)
    assert sum(map(len, seen[1])) < 600


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    got = quality_mil.evaluate(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.9
