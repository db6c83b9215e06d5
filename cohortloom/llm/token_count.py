"""Token counts by rank-synchronous merging of ragged arrays (operator 8).

A batch's new pre-tokens are held as one flat array of symbols with the row of each. In every round all
adjacent pairs are looked up at once, each row finds its lowest rank, and all rows apply theirs at the
same time (all places of that pair, left to right, without overlap; a pair that a merge makes has a
higher rank, so this equals merging one place at a time). Rows without a pair left are counted and go.
Counts of recent pre-tokens are kept in a table of bounded size in each worker.

Defined results: a null text is empty and has 0 tokens; a null doc_id stays null; strings of added tokens inside a text count as
one token, as the library does by default; repeated rows each give a row; other columns are ignored;
no rows give no rows. A long text is read in pieces that end before white space, where no pre-token
can span, so memory is bounded by the longest run without white space.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .arrowtext import chunks, string_buffers, tidy

#: Pre-tokens whose counts a worker keeps; beyond it the table starts afresh.
CACHE_WORDS = 400_000
#: Characters of a text that are split at once.
PIECE_CHARS = 1 << 19
# Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
NONE = np.int64(1 << 40)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairTable:
    """Open-addressing table from pairs of symbols to (rank, merged symbol), probed for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(len(keys) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.rank = np.full(1 << bits, NONE, np.int64)
        self.merged = np.zeros(1 << bits, np.int32)
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            free = self.keys[slot] == np.iinfo(np.uint64).max
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            won = first[free[first]]
            self.keys[slot[won]], self.rank[slot[won]], self.merged[slot[won]] = keys[todo[won]], todo[won], merged[todo[won]]
            left_over = np.ones(len(todo), bool)
            left_over[won] = False
            todo, slot = todo[left_over], (slot[left_over] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, slot) of each pair; rank NONE where there is none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        here = self.keys[slot]
        rank = np.where(here == keys, self.rank[slot], NONE)
        open_ = np.flatnonzero((here != keys) & (here != np.iinfo(np.uint64).max))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            here = self.keys[slot[open_]]
            hit = here == keys[open_]
            rank[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (here != np.iinfo(np.uint64).max)]
        return rank, slot


def surviving(symbols: np.ndarray, row: np.ndarray, n_rows: int, pairs: PairTable) -> np.ndarray:
    """How many symbols of each row are left after all merges. row ascends."""
    left = np.zeros(n_rows, np.int64)
    while len(symbols):
        joined = row[1:] == row[:-1]
        rank = np.full(len(symbols), NONE, np.int64)
        at = np.flatnonzero(joined)
        rank[at], slot = pairs.find(symbols[at], symbols[at + 1])
        where = np.zeros(len(symbols), np.int64)
        where[at] = slot
        starts = np.flatnonzero(np.concatenate([[True], ~joined]))
        low = np.minimum.reduceat(rank, starts)
        size = np.diff(np.append(starts, len(symbols)))
        ended = low == NONE
        left[row[starts[ended]]] = size[ended]
        low = np.repeat(low, size)
        hit = (rank == low) & (low != NONE)
        p = np.flatnonzero(hit)
        if not len(p):
            break
        run = np.concatenate([[True], p[1:] != p[:-1] + 1])  # aaa: the first and third place, not the second
        first = np.maximum.accumulate(np.where(run, np.arange(len(p)), 0))
        p = p[(np.arange(len(p)) - first) % 2 == 0]
        symbols = symbols.copy()
        symbols[p] = pairs.merged[where[p]]
        keep = np.repeat(~ended, size)
        keep[p + 1] = False
        symbols, row = symbols[keep], row[keep]
    return left


class WordCutter:
    """Cuts texts into pre-tokens."""

    def __init__(self):
        self.words = regex.compile(PATTERN)
        self.edge = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text, some at a time."""
        if len(text) <= PIECE_CHARS:
            yield self.words.findall(text)
            return
        at = 0
        while at < len(text):
            cut = self.edge.search(text, min(at + PIECE_CHARS, len(text)))
            to = cut.start() if cut else len(text)
            yield self.words.findall(text[at:to])
            at = to


class Counter(WordCutter):
    """Counts tokens by a byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, vocabulary: str):
        super().__init__()
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or not pre["use_regex"] or model["ignore_merges"]:
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        if any(t[flag] for t in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in white space or stand alone only are not supported")
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = PairTable(*(np.array([ids[f(m)] for m in merges]) for f in (lambda m: m[0], lambda m: m[1], lambda m: m[0] + m[1])))
        self.symbol = np.array([ids[c] for _, c in sorted(byte_letters().items())], np.int64)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.known: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        """Adds the counts of new pre-tokens."""
        words = list(words)
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        n = surviving(self.symbol[flat], np.repeat(np.arange(len(raw)), size), len(raw), self.pairs)
        self.known.update(zip(words, n.tolist()))

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            new = set()
            for _, w in waiting:
                new.update(w)
            new.difference_update(self.known)
            if new:
                before = len(self.known)
                self.learn(new)
                if len(self.known) < before + len(new):  # the table started afresh
                    self.learn(set().union(*(w for _, w in waiting)).difference(self.known))
            known = self.known
            for i, w in waiting:
                out[i] += sum(map(known.__getitem__, w))
            waiting.clear()
            held = 0

        for i, text in enumerate(texts):
            parts = [text]
            if self.added and self.added.search(text):
                parts = self.added.split(text)
                out[i] += len(parts) - 1
            for part in parts:
                for words in self.pieces(part) if part else ():
                    waiting.append((i, words))
                    held += len(words)
                    if held > 300_000:
                        flush()
        flush()
        return out


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. vocabulary: path of the JSON file, present on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in batches:
            counter = counter or Counter(vocabulary)
            text = b.column("text").fill_null("")
            _, offsets = string_buffers(text)
            n: list[int] = []
            for i, j in chunks(offsets):
                n += counter.count(text.slice(i, j - i).to_pylist())
            n_tokens = np.array(n, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n_tokens), pa.array(n_tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
