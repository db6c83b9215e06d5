"""Periodic runs of words by a harmonic grid (operator 13).

The words of a text are `[^\\x20\\x09-\\x0D]+`. A run is a longest stretch with a smallest period q, so that words q apart are
equal, of at least max(24, 3 q) words. For each period p the places 0, p, 2p, ... form a grid, in all n ln n places for n
words. Between neighbours jp and (j + 1) p the longest common extension forward (from a suffix array with its common prefixes)
and backward (from the array of the reversed words), both by range minima, gives the stretch of period p around them; a stretch
of three periods or more has such a pair inside. It is also found with the multiples of its period, with the same ends, so the
smallest period of equal ends is its own.

A stretch of three periods with jp in its first one has an extension of more than p words from jp, so grid places whose words
at jp, jp + 1 and (j + 1) p differ from those one period on are left out before any extension is asked for; arrays are built for the
texts that have places left.

A text stays whole in its row, nothing is shuffled, and a task holds the texts of about BLOCK_WORDS words (one longer text goes
alone): 8 bytes for each word and power of two below its length, and the grid by pieces of GRID places.

Defined results: a null or empty text, or one without words, has no runs and the hash of the empty string twice; a null doc_id is
a row like any other (`altered` leaves its words as they are); repeated rows keep a row each; of runs with the same quotient
length / period the first start wins, then the smallest period; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrowtext import tidy

#: Fewest words and fewest periods of a run.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words that a task looks at together, and places of the grid at once.
BLOCK_WORDS, GRID = 100_000, 1 << 20


class Extensions:
    """Longest common extensions of places of a sequence, by its suffix array, common prefixes and range minima."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        levels = [np.unique(ids, return_inverse=True)[1].astype(np.int32)]
        width = 1
        while levels[-1].max(initial=0) < n - 1 and width < n:
            key = levels[-1].astype(np.int64) * (n + 1)
            key[: n - width] += levels[-1][width:] + 1
            order = np.argsort(key)
            new = np.zeros(n, np.int32)
            new[1:] = np.cumsum(key[order[1:]] != key[order[:-1]])
            rank = np.empty(n, np.int32)
            rank[order] = new
            levels.append(rank)
            width *= 2
        self.rank = levels[-1]
        suffixes = np.empty(n, np.int64)
        suffixes[self.rank] = np.arange(n)
        # common prefixes of neighbouring suffixes, from the longest power of two down
        a, b = suffixes[:-1].copy(), suffixes[1:].copy()
        common = np.zeros(max(n - 1, 0), np.int32)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero(np.maximum(a, b) + (1 << k) <= n)
            same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
            for x in (a, b, common):
                x[same] += 1 << k
        self.minima = [common]
        half = 1
        while 2 * half <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-half], last[half:]))
            half *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the suffixes at a and b, which differ in each row."""
        low, high = np.minimum(self.rank[a], self.rank[b]).astype(np.int64), np.maximum(self.rank[a], self.rank[b]).astype(np.int64)
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(power).tolist():
            rows = power == k
            out[rows] = np.minimum(self.minima[k][low[rows]], self.minima[k][high[rows] - (1 << k)])
        return out


def _grid(words: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, period) of the grid places whose nearest words allow three periods."""
    n = np.diff(ptr)
    most = np.where(n >= MIN_WORDS, n // MIN_PERIODS, 0)
    text = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    places = (n[text] - 1) // period - 1  # (j + 2) p is the text's last word at most
    ends = np.cumsum(places)
    found, i = [np.zeros((3, 0), np.int64)], 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + GRID, "right")))
        count = places[i:j]
        p = np.repeat(period[i:j], count)
        at = (np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)) * p + np.repeat(ptr[text[i:j]], count)
        keep = np.flatnonzero(words[at] == words[at + p])
        keep = keep[words[at[keep] + 1] == words[at[keep] + p[keep] + 1]]
        keep = keep[words[at[keep] + p[keep]] == words[at[keep] + 2 * p[keep]]]
        found.append(np.stack([np.repeat(text[i:j], count)[keep], at[keep], p[keep]]))
        i = j
    return tuple(np.concatenate(found, axis=1))


def find_runs(words: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Rows text, start, length, period of all runs, in this order; words[ptr[d]:ptr[d + 1]] are the words of text d, as numbers."""
    text, at, period = _grid(words, ptr)
    if not len(text):
        return np.zeros((0, 4), np.int64)
    # the texts that have places left, one after another, with a sign of its own before each and after the last
    used = np.unique(text)
    size = np.diff(ptr)[used]
    begin = np.cumsum(size + 1) - size
    line = np.empty(int(size.sum()) + len(used) + 1, np.int64)
    inside = np.ones(len(line), bool)
    inside[np.append(begin - 1, len(line) - 1)] = False
    line[inside] = words[np.repeat(ptr[:-1][used] - np.cumsum(size) + size, size) + np.arange(size.sum())]
    line[~inside] = -1 - np.arange(len(used) + 1)
    seat = np.searchsorted(used, text)
    x = at - ptr[text] + begin[seat]
    y = x + period
    end = y + Extensions(line)(x, y)
    last = len(line) - 1
    start = x - Extensions(line[::-1])(last - (x - 1), last - (y - 1))
    long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
    rows = np.stack([text, start - begin[seat], end - start, period], axis=1)[long]
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


_OUT = "doc_id long, words int, runs array<struct<start:long, length:long, period:long>>, best struct<start:long, length:long, period:long>, collapsed string"


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for b in batches:
        ids, texts, hashes = b.column("doc_id"), b.column("text").cast(pa.large_binary()), b.column("h").to_pylist()
        i = 0
        while i < b.num_rows:
            lines, numbers, j, total = [], [], i, 0
            while j < b.num_rows and (j == i or total < BLOCK_WORDS):
                words = (texts[j].as_py() or b"").split()  # at exactly \x20 and \x09-\x0D
                if hashes[j] is not None and hashes[j] % 10 == 0 and words:
                    g, n = hashes[j] // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words = words[:a] + [words[a + k % p] for k in range(n - a)]
                seen: dict[bytes, int] = {}
                numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
                lines.append(words)
                total += len(words)
                j += 1
            ptr = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)
            runs = find_runs(np.concatenate(numbers), ptr)
            cut = np.searchsorted(runs[:, 0], np.arange(len(lines) + 1))
            made, best, kept = [], [], []
            for d, words in enumerate(lines):
                mine = runs[cut[d] : cut[d + 1], 1:].tolist()
                made.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                if mine:
                    best.append(dict(zip(("start", "length", "period"), min(mine, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))))
                    change = np.zeros(len(words) + 1, np.int64)
                    for s, length, q in mine:
                        change[s + q] += 1
                        change[s + length] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                else:
                    best.append(None)
                kept.append(b" ".join(words))
            out = [ids.slice(i, j - i), pa.array(np.diff(ptr), pa.int32()), pa.array(made, pa.list_(kind)), pa.array(best, kind), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "words", "runs", "best", "collapsed"])
            i = j


def periodic_runs(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """doc_id, words, all runs (start, length, period), the best of them and the text with each run collapsed to its first period.

    altered: a number h for each row; where h % 10 is 0 the words from a place on repeat by a period, both drawn from h.
    """
    h = F.lit(None).cast("long") if altered is None else altered.cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), h.alias("h")).mapInArrow(tidy(_described), _OUT)


def run_digests(docs: DataFrame) -> DataFrame:
    """The runs of every text, a tenth of which repeat by a drawn period, with digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, F.crc32(F.col("doc_id").cast("long").cast("string")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    milli = F.expr("(1000 * best.length) div best.period")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
