"""Quality classifier by attention-based multiple-instance learning (operator 6).

A text is a bag of passages of PASSAGE_WORDS words; only the bag has a label. Every passage is encoded
(shape of the characters and words, hashed words, one tanh layer), gated attention learned from the
labels weighs the passages, and a logistic unit scores the weighted representation.

The network is trained on a bounded, hash-chosen sample of labelled documents (MAX_LABELLED of them and MAX_PASSAGES
passages, in expectation, whatever documents and labels are repeated; of a longer bag, BAG_PASSAGES evenly spaced passages) and
has a few thousand weights; scoring streams over all rows and whole texts.

Defined results: a null or empty text is one passage without words and gets a score; with no labelled
rows every score is 0.5; repeated rows each give a row; repeated labels of a document each count; a null doc_id has no label
and stays null; a very long text is scored by all its passages; equal texts have equal scores; other columns are ignored; no
rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrowtext import chunks, mix, string_buffers, tidy, Words
from .language_id import held_out
from .session import discard, written

#: Labelled documents, and passages of them, that the network learns from, in expectation; most passages of one document.
MAX_LABELLED, MAX_PASSAGES, BAG_PASSAGES = 6000, 60_000, 256
PASSAGE_WORDS = 64
HASHED = 64
#: Hashed words count for less than shapes, so that few labels do not make the network learn words by heart.
HASHED_WEIGHT = 0.2
HIDDEN = 24
ATTENTION = 12
EPOCHS = 30
THRESHOLD = 0.3

_CLASSES = 12
_CLASS = np.full(256, 0, np.int64)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[46, 44]] = 4  # . ,
_CLASS[[33, 63]] = 5  # ! ?
_CLASS[[35, 36, 37, 38, 42, 64, 94]] = 6  # # $ % & * @ ^
_CLASS[[124, 60, 62, 123, 125, 91, 93, 61, 95, 126, 96, 92, 47]] = 7
_CLASS[[34, 39, 40, 41, 43, 45, 58, 59]] = 8
_CLASS[128:256] = 9
_CLASS[[9, 10, 11, 12, 13]] = 10
_CLASS[32] = 11
SHAPE = 20
FEATURES = SHAPE + HASHED


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, ptr of each text's passages); a text without words has one passage."""
    words = Words(data, offsets)
    count = np.diff(words.ptr)
    n_pass = np.maximum(1, -(-count // PASSAGE_WORDS))
    ptr = np.concatenate([[0], np.cumsum(n_pass)])
    total = int(ptr[-1])
    out = np.zeros((total, FEATURES), np.float32)
    if not len(data):
        return out, ptr
    doc = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(doc)) - words.ptr[doc]
    passage = ptr[doc] + place // PASSAGE_WORDS
    n = np.maximum(1, np.bincount(passage, minlength=total)).astype(np.float64)
    # a passage has the bytes from its first word to the next passage; a text's first one, from the text's start
    cut = np.flatnonzero((place % PASSAGE_WORDS == 0) & (place > 0))
    at, owner = np.concatenate([offsets[:-1], words.start[cut]]), np.concatenate([ptr[:-1], passage[cut]])
    order = np.lexsort((owner, at))
    here = np.repeat(owner[order], np.diff(np.append(at[order], len(data))))
    by_class = np.bincount(here * _CLASSES + _CLASS[data], minlength=total * _CLASSES).reshape(total, _CLASSES)[:total]
    size = np.maximum(1, by_class.sum(axis=1))
    out[:, :_CLASSES] = by_class / size[:, None]
    length = (words.end - words.start).astype(np.float64)
    mean = np.bincount(passage, length, total) / n
    out[:, 12] = np.log1p(mean)
    out[:, 13] = np.log1p(np.bincount(passage, (length - mean[passage]) ** 2, total) / n)
    out[:, 14] = np.log(n) / np.log(PASSAGE_WORDS)
    same = np.zeros(len(doc))
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (passage[1:] == passage[:-1])
    out[:, 15] = np.bincount(passage, same, total) / n
    key = mix(words.hash + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    out[:, 16] = np.bincount(passage[first], minlength=total) / n
    upper = (data[words.start] >= 65) & (data[words.start] <= 90)
    out[:, 17] = np.bincount(passage, upper, total) / n
    last = _CLASS[data[words.end - 1]]
    out[:, 18] = np.bincount(passage, last == 6, total) / n
    out[:, 19] = np.bincount(passage, length == 1, total) / n
    bucket = (words.hash % np.uint64(HASHED)).astype(np.int64)
    sign = np.where((words.hash >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    out[:, SHAPE:] = np.bincount(passage * HASHED + bucket, sign, total * HASHED).reshape(total, HASHED) / np.sqrt(n)[:, None]
    return out, ptr


@dataclass
class Network:
    """Weights; mean and scale make the features even."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, ptr: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        x[:, SHAPE:] *= HASHED_WEIGHT
        h = np.tanh(x @ w["enc"] + w["enc_b"])
        t, g = np.tanh(h @ w["att"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        logit = (t * g) @ w["att_out"]
        size = np.diff(ptr)
        top = np.maximum.reduceat(logit, ptr[:-1])
        e = np.exp(logit - np.repeat(top, size))
        a = e / np.repeat(np.add.reduceat(e, ptr[:-1]), size)
        z = np.add.reduceat(h * a[:, None], ptr[:-1], axis=0)
        p = 1 / (1 + np.exp(-(z @ w["out"] + w["out_b"])))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": p}

    def score(self, x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        return self.forward(x, ptr)["p"] if self.w else np.full(len(ptr) - 1, 0.5)


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Adam on the log loss of the bags' labels."""
    if not bags:
        return Network(np.zeros(FEATURES), np.ones(FEATURES), {})
    every = np.concatenate(bags)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    rng = np.random.default_rng(seed)
    shape = {"enc": (FEATURES, HIDDEN), "enc_b": (HIDDEN,), "att": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION), "att_out": (ATTENTION,), "out": (HIDDEN,), "out_b": ()}
    w = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if s and not k.endswith("_b") else np.zeros(s)) for k, s in shape.items()}
    net = Network(mean, scale, w)
    m, v, step = {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), 64):
            own = order[i : i + 64]
            x = np.concatenate([bags[k] for k in own])
            size = np.array([len(bags[k]) for k in own])
            ptr = np.concatenate([[0], np.cumsum(size)])
            f = net.forward(x, ptr)
            grad = gradients(w, f, np.repeat(np.arange(len(own)), size), (f["p"] - labels[own]) / len(own))
            step += 1
            for k in w:
                g = grad[k] + 1e-4 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def gradients(w: dict, f: dict, bag: np.ndarray, d: np.ndarray) -> dict[str, np.ndarray]:
    """Of the log loss; d: its derivative by each bag's logit; bag: the bag of each passage."""
    dz = d[:, None] * w["out"]
    da = (f["h"] * dz[bag]).sum(axis=1)
    base = np.bincount(bag, f["a"] * da, len(d))
    dlogit = f["a"] * (da - base[bag])
    dt = dlogit[:, None] * w["att_out"] * f["g"] * (1 - f["t"] ** 2)
    dg = dlogit[:, None] * w["att_out"] * f["t"] * f["g"] * (1 - f["g"])
    dh = f["a"][:, None] * dz[bag] + dt @ w["att"].T + dg @ w["gate"].T
    dpre = dh * (1 - f["h"] ** 2)
    return {"enc": f["x"].T @ dpre, "enc_b": dpre.sum(axis=0), "att": f["h"].T @ dt, "gate": f["h"].T @ dg, "att_out": (f["t"] * f["g"]).T @ dlogit, "out": f["z"].T @ d, "out_b": d.sum()}


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_passages: int = MAX_PASSAGES) -> Network:
    """Learns from the rows of labels whose crc32(doc_id) mod 5 is not 0."""
    marked = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), 5, 0)).select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    share = min(1.0, max_labelled / max(1, marked.count()))
    sample = marked.where(_chance(F.xxhash64(F.lit(23), "doc_id")) < share)
    if sample.count() <= 2 * max_labelled:  # else one doc_id has many labels
        sample = F.broadcast(sample)
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(sample, "doc_id")
    bags = written(pairs.mapInArrow(tidy(_bags), "doc_id long, quality int, bag binary, passages int"), "bags")
    # a document or a label can be repeated, so what is collected is bounded by what the join gave
    n, passages = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("passages"), F.lit(0))).first()
    share = min(1.0, 1.1 * max_labelled / max(1, n), max_passages / max(1, passages))
    got = bags.where(_chance(F.xxhash64(F.lit(29), "doc_id", "quality", "bag")) < share) if share < 1 else bags
    got = got.select("doc_id", "quality", "bag").toArrow()
    discard(bags)
    rows = sorted(zip(got["doc_id"].to_pylist(), got["quality"].to_pylist(), got["bag"].to_pylist()))
    return train([np.frombuffer(x, np.float32).reshape(-1, FEATURES) for _, _, x in rows], np.array([q for _, q, _ in rows], float))


def _chance(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of each text's passages."""
    for b in batches:
        data, offsets = string_buffers(b.column("text"))
        bags, passages = [], []
        for i, j in chunks(offsets):
            x, ptr = encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            for k in range(j - i):
                n = int(ptr[k + 1] - ptr[k])
                own = np.arange(n) if n <= BAG_PASSAGES else np.linspace(0, n - 1, BAG_PASSAGES).astype(np.int64)
                bags.append(x[ptr[k] + own].tobytes())
                passages.append(len(own))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(bags, pa.binary()), pa.array(passages, pa.int32())], names=["doc_id", "quality", "bag", "passages"])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, score and predicted of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            scores = [np.zeros(0)]
            for i, j in chunks(offsets):
                scores.append(shared.value.score(*encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])))
            p = np.concatenate(scores)
            columns = {c: b.column(c) for c in b.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(p), "predicted": pa.array((p >= THRESHOLD).astype(np.int32))})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), "doc_id long, score double, predicted int")


def keep(docs: DataFrame, network: Network) -> DataFrame:
    """The rows whose score is at least THRESHOLD, with all their columns; rows are filtered where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column(b.schema.get_field_index("text")))
            good = [np.zeros(0, bool)]
            for i, j in chunks(offsets):
                good.append(shared.value.score(*encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) >= THRESHOLD)
            yield b.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(tidy(run), docs.schema)


def evaluate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the labels that are not held out and scores every row, with held_out."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
