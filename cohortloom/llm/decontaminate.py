"""Benchmark decontamination by CGK embedding, bit sampling and exact edit verification (operator 4).

Texts become words (runs of letters and digits, without case). From each place of a text a random walk
reads words: step j gives out the current word and moves on if bit j of the word's hash is set. This
is the CGK embedding; two places whose words differ by few edits give out mostly the same words, so
edit distance becomes Hamming distance. A repetition takes some of the first outputs as a bucket key
(bit sampling); a walk that has passed its text's end is in no bucket. Benchmark items are walked from anchors all along, so that an edit spoils
some anchors only: every third word by long walks, and every word by short ones for items of few words, of which a copy keeps short
stretches only (WALKS). A place that shares a bucket with an anchor is a candidate: the item-sized window
around it is compared by exact word edit distance, with the window's ends free.

All places of all texts are walked; a walk stops as soon as its outputs so far are no anchor's. The walks alone find over 0.9 of the copies with a quarter
of their words edited, at every length from SHORT words on (a test without the rest measures it). To find the others as well, every item has exact seeds: of an item that
`most` edits are allowed for, cut into most + 1 pieces, one piece at least is without an edit, and each place
of a text that has the first words of a piece (SEED_WORDS at most) is a candidate.
Items of fewer than SHORT words have seeds only. An item contaminates a text when 1 - distance / words of
the item is at least 0.75.

The items are a query set: they are sent to the tasks in blocks of bounded size (BLOCK_BYTES of text, or one longer item), one
pass over the documents for each block, so a large benchmark needs more passes and no more memory.

Defined results: one row per text (row of documents) and item found in it, with the best window, ties to
the earliest; null or empty texts have none, items without words match nothing; a null doc_id or item_id is given out as null;
repeated items and rows each give rows; a very long text is searched as a whole; other columns are ignored; no rows, or no
items, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .arrowtext import chunks, mix, string_buffers, tidy, Words
from .session import written

SIMILARITY = 0.75
#: Kinds of walks: fewest and most words of an item, repetitions, outputs of a walk, outputs sampled in a repetition, words from anchor to
#: anchor, and words after the last anchor. A copy of few words keeps short stretches only, so short items have short walks from every word, too.
WALKS = [(8, 1 << 30, 6, 14, 5, 3, 10), (8, 24, 3, 5, 3, 1, 2)]
#: Fewest words of an item that is walked.
SHORT = 8
#: Most words of a seed.
SEED_WORDS = 4
#: Items, and bytes of items, that are sent to the tasks at once. So many bytes are 1 M words at most; their tables take
#: 100 MB at most (a test measures it), in a worker as on the driver.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 2 << 20
#: Bits of a table for each key in it.
KEY_BITS = 16

_U = np.uint64
_FOLD = _U(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, item_id long, edit_distance int, item_words int, similarity double, first_word long, last_word long"


def _table(keys: np.ndarray) -> np.ndarray:
    """Bits that are set at the keys."""
    size = 1 << max(16, int(len(keys) * KEY_BITS).bit_length())
    bits = np.zeros(size, bool)
    bits[(keys & _U(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _may_be_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & _U(8 * len(table) - 1)
    return (table[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & np.uint8(1) != 0


def _sampled(repetitions: int, steps: int, k: int, seed: int = 9) -> list[np.ndarray]:
    """The sampled steps of each repetition, no two of them neighbours (these often give out the same word)."""
    rng = np.random.default_rng(seed)
    return [np.sort(rng.choice(steps - k + 1, k, replace=False)) + np.arange(k) for _ in range(repetitions)]


def _bits(hashes: np.ndarray, repetition: int) -> np.ndarray:
    """A word's moves in a repetition; the end mark 0 never moves."""
    return np.where(hashes == 0, _U(0), mix(hashes ^ mix(np.array([repetition + 1], _U))))


def _walk(hashes: np.ndarray, bits: np.ndarray, at: np.ndarray, sampled: np.ndarray, may: list[np.ndarray] | None, whole: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of the walks from `at` whose sampled outputs could be an anchor's. may: tables of the keys so far.

    Without tables, the anchors' own walks: the key is 0 where a walk passes the end, or where in all outputs, K of them,
    fewer than K - 1 places of the text appear, which would put common words in one bucket.
    """
    place, key, step = at, np.zeros(len(at), _U), 0
    before, moves = at, np.zeros(len(at), np.int64)
    now = at.copy()
    for k, s in enumerate(sampled):
        while step < s:
            now = now + ((bits[now] >> _U(step)) & _U(1)).astype(now.dtype)
            step += 1
        here = hashes[now]
        with np.errstate(over="ignore"):
            key = mix(key * _FOLD + here)
        if may is None:
            moves += (now != before) | (k == 0)
            before = now
            ended_, few = here == 0, (k == whole - 1) & (moves < whole - 1)
            key[ended_ | few] = 0
        else:
            keep = _may_be_in(may[k], key) & (here != 0)
            place, key, now = place[keep], key[keep], now[keep]
            if not len(place):
                break
    return place, key


def _grams(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(g, key of the g words from each place that has them) for g of 1 to SEED_WORDS."""
    key = np.zeros(len(hashes), _U)
    for g in range(1, SEED_WORDS + 1):
        with np.errstate(over="ignore"):
            key = mix(key[: max(0, len(hashes) - g + 1)] * _FOLD + hashes[g - 1 :])
        yield g, key


def _most(similarity: float, words: int) -> int:
    """Edits that an item of so many words may have."""
    return int(np.floor((1 - similarity) * words + 1e-9))


def _shared(distinct: np.ndarray, uses: np.ndarray, window: np.ndarray) -> int:
    """How many words of an item the window has, each as often as both have it. distinct: the item's words, which are not none, and their uses."""
    at = np.minimum(np.searchsorted(distinct, window), len(distinct) - 1)
    return int(np.minimum(np.bincount(at[distinct[at] == window], minlength=len(distinct)), uses).sum())


def ended(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes with an end mark after each text, places that are words, start of each text)."""
    n = len(words.ptr) - 1
    starts = words.ptr[:-1] + np.arange(n)
    count = np.diff(words.ptr)
    out = np.zeros(len(words.hash) + n, _U)
    at = np.arange(len(words.hash)) + np.repeat(np.arange(n), count)
    out[at] = words.hash
    return out, at, starts


def edit_distance(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(distance, from, to): the least word edits between the item and any stretch of the window, the earliest one."""
    m = len(window)
    cost = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    steps = np.arange(m + 1)
    for i, w in enumerate(item):
        swap = cost[:-1] + (window != w)
        drop = cost + 1
        best = drop.copy()
        begin = start.copy()
        better = (swap < best[1:]) | ((swap == best[1:]) & (start[:-1] < begin[1:]))
        best[1:][better] = swap[better]
        begin[1:][better] = start[:-1][better]
        # insertions: best[j] = min over k <= j of best[k] + j - k
        level = (best - steps) * (4 * m + 8) + begin
        low = np.minimum.accumulate(level)
        cost, start = low // (4 * m + 8) + steps, low % (4 * m + 8)
    to = int(cost.argmin())
    return int(cost[to]), int(start[to]), to


class Items:
    """A block of benchmark items with their anchors' bucket keys and their seeds."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float = SIMILARITY):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), plain=True)
        self.ids = ids
        self.words = [words.hash[a:b] for a, b in zip(words.ptr[:-1], words.ptr[1:])]
        self.distinct = [np.unique(w, return_counts=True) for w in self.words]
        hashes, _, starts = ended(words)
        # of each kind of walk: per repetition the sampled steps, which keys may be an anchor's, and keys, items and offsets in order of the key
        self.walks: list[list[tuple]] = []
        self.anchors = 0
        for least, most, repetitions, steps, k, apart, rest in WALKS:
            anchors = [(i, o) for i, w in enumerate(self.words) if least <= len(w) < most for o in range(0, max(1, len(w) - rest + 1), apart)]
            self.anchors += len(anchors)
            owner, offset = (np.array([x[c] for x in anchors], np.int32) for c in (0, 1))
            at, made = starts[owner] + offset, []
            for r, sampled in enumerate(_sampled(repetitions, steps, k) if anchors else []):
                bits, tables = _bits(hashes, r), []
                for j in range(k):
                    _, key = _walk(hashes, bits, at, sampled[: j + 1], None, k)
                    tables.append(_table(key[key != 0]))
                order = np.flatnonzero(key != 0)
                order = order[np.argsort(key[order], kind="stable")]
                made.append((sampled, tables, key[order], owner[order], offset[order]))
            self.walks.append(made)
        # for each seed length: which keys may be a seed's, and keys, items and offsets in order of the key
        seeds: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            n = min(_most(similarity, len(w)) + 1, len(w))
            cuts = [len(w) * c // n for c in range(n + 1)] if n else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                seeds.setdefault(min(b - a, SEED_WORDS), []).append((i, a))
        self.seeds: dict[int, tuple[np.ndarray, ...]] = {}
        for g, grams in _grams(hashes):
            if g in seeds:
                owner, offset = np.array(seeds[g], np.int64).T
                key = grams[starts[owner] + offset]
                order = np.argsort(key, kind="stable")
                self.seeds[g] = _table(key), key[order], owner[order], offset[order]

    def candidates(self, hashes: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows (text, place of the item's first word, item), distinct and in order; the place can lie outside its text."""
        found = [np.zeros((0, 3), np.int64)]
        text = lambda place: np.searchsorted(starts, place, "right") - 1

        def add(place: np.ndarray, key: np.ndarray, keys: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> None:
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            n = hi - lo
            take = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else lo, n) + np.arange(n.sum())
            place = np.repeat(place, n)
            found.append(np.stack([text(place), place - offset[take], owner[take]], axis=1))

        for r in range(max(map(len, self.walks))):
            bits = _bits(hashes, r)
            for sampled, tables, keys, owner, offset in [w[r] for w in self.walks if r < len(w)]:
                place, key = _walk(hashes, bits, at, sampled, tables)
                add(place, key, keys, owner, offset)
        for g, grams in _grams(hashes):
            if g in self.seeds:
                table, keys, owner, offset = self.seeds[g]
                place = np.flatnonzero(_may_be_in(table, grams))
                add(place, grams[place], keys, owner, offset)
        return np.unique(np.concatenate(found), axis=0)

    def matches(self, data: np.ndarray, offsets: np.ndarray, similarity: float) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, item, distance, words of the item, first word, end) of every match in some texts."""
        words = Words(data, offsets, plain=True)
        hashes, at, starts = ended(words)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        windows: dict[tuple[int, int], list[list[int]]] = {}
        for d, place, item in self.candidates(hashes, at, starts).tolist():
            n = len(self.words[item])
            most = _most(similarity, n)
            lo, hi = int(words.ptr[d]), int(words.ptr[d + 1])
            a = max(lo, lo + place - int(starts[d]) - most - 1)
            b = min(hi, lo + place - int(starts[d]) + n + most + 1)
            mine = windows.setdefault((d, item), [])
            # places come in order; windows that overlap by half, with what several anchors of one copy give, are one
            if mine and mine[-1][1] - a >= n // 2:
                mine[-1][1] = max(b, mine[-1][1])
            else:
                mine.append([a, b])
        for (d, item), mine in windows.items():
            w, lo = self.words[item], int(words.ptr[d])
            most = _most(similarity, len(w))
            for a, b in mine:
                window = words.hash[a:b]
                if b - a < len(w) - most or _shared(*self.distinct[item], window) < len(w) - most:
                    continue
                distance, start, to = edit_distance(w, window)
                if distance <= most:
                    found = (distance, a - lo + start, a - lo + to)
                    best[d, item] = min(best.get((d, item), found), found)
        for (d, item), (distance, start, to) in sorted(best.items()):
            yield d, item, distance, len(self.words[item]), start, to


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, edit_distance, item_words, similarity, first_word, last_word of every leak."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return reduce(DataFrame.unionAll, [texts.mapInArrow(tidy(_finder(shared, similarity)), SCHEMA) for shared in _shared_items(benchmark, similarity)])


def keep(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows in which no item is found, with all their columns; rows are filtered where they are."""
    for k, shared in enumerate(_shared_items(benchmark, similarity)):
        docs = (written(docs, "decontaminated") if k else docs).mapInArrow(tidy(_keeper(shared, similarity)), docs.schema)
    return docs


def _shared_items(benchmark: DataFrame, similarity: float) -> Iterator[Broadcast]:
    """The items, broadcast in blocks."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.col("text").isNotNull())
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").toArrow()
        yield spark.sparkContext.broadcast(Items(block["item_id"].to_pylist(), block["text"].to_pylist(), similarity))


def _keeper(shared, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column(b.schema.get_field_index("text")))
            clean = np.ones(b.num_rows, bool)
            for i, j in chunks(offsets):
                for d, *_ in shared.value.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], similarity):
                    clean[i + d] = False
            yield b.filter(pa.array(clean))

    return run


def _finder(shared, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            ids, out = b.column("doc_id").to_pylist(), []
            for i, j in chunks(offsets):
                for d, item, distance, n, start, to in shared.value.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], similarity):
                    out.append((ids[i + d], shared.value.ids[item], distance, n, 1 - distance / n, start, to - 1))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    return run
