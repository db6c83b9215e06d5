"""Removal of repeated byte strings by a run-length index (operator 11).

A byte goes if a string of LENGTH bytes covers it that also starts earlier (smaller doc_id, or same text, earlier start).

Every window of LENGTH bytes has an anchor, the smallest hash of its ANCHOR-byte strings, at the first place where it has it. Equal
windows have equal anchors. The windows that follow one another with one place of an anchor are a segment, so all windows equal to one lie
in other segments with the same anchor: two windows of a segment have it at different distances, and are different.

1. Anchors are counted. Those that occur once have no repeated window; a bit table of bounded size keeps most of their segments
   out of what follows (it decides nothing).
2. Equal segments become one, with their first place. A third of all rows may hold it: it is combined before the shuffle.
3. Anchors with one segment only are done: what is not at its first place goes. The different segments of the other anchors, the first
   place of each, go to the anchor's task, which indexes them by blocks of whole anchors: the Burrows-Wheeler transform of
   the segments is kept as its runs, with the suffixes at the runs' ends. From these samples alone, matching statistics stream
   over the text: at the first suffix of a run the match with its neighbour is known, and each next place has one byte less of the
   same match, until the next sample. Matches of LENGTH bytes or more chain equal windows, and the first of a chain stays.
4. An anchor with more than MOST_SEGMENTS different segments (a frequent line between different neighbours) would be a hot group. Its
   windows are compared one by one instead, by 128 bits of hash, combined before the shuffle.
5. What comes first is sent back to its text; all other windows with a repeated anchor go.

Defined results: a null or empty text has no bytes; texts shorter than LENGTH lose none; a null doc_id comes before all others; texts with equal
doc_id go by a hash of doc_id and text; of rows with equal doc_id and text one is first and the others are copies of it; other
columns are ignored; no rows give no rows. A long text is cut into segments by CHUNK_BYTES, with overlap. Different segments share 128 bits of hash
with a chance of about (number of segments)^2 / 2^129.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrowtext import _BYTE, _BASE, mix, powers, string_buffers, tidy
from .components import HOT_PARTS, join_by_hot_keys
from .session import discard, written

LENGTH, ANCHOR = 100, 32
#: Most segments of an anchor that are indexed together, and bytes of segments in an index (one anchor's may be more).
MOST_SEGMENTS, INDEX_BYTES = 4096, 1 << 17
#: Bytes of text (a power of two) that are hashed at once: arrays of their numbers stay in a core's cache.
CHUNK_BYTES = 1 << 17
#: Bytes of texts that go on together.
CUT_BYTES = 4 << 20
#: Fewest and most slots of a bit table (eight for each key that is looked for; with more keys it holds back less).
SLOTS = 1 << 20, 1 << 27
#: Copies of a row that are given out at once.
OUT_ROWS = 4096

_U = np.uint64
#: Places of a chunk.
_PLACES = _U(CHUNK_BYTES - 1)
_INVERSE = _U(pow(_BASE, -1, 1 << 64))


class RunIndex:
    """The run-length compressed Burrows-Wheeler transform of some byte strings, with sampled run ends.

    heads and sizes: byte and length of each run (-1: a string begins there; such rows are runs of their own). place: the
    suffix at a run's first row; before: the suffix in the row above, the last of the run before (-1: none); common: bytes that these two share.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        n = len(data)
        size = np.diff(np.concatenate([[0], ends]))
        left = np.repeat(ends, size) - np.arange(n)  # bytes from here to the end of the string
        width, levels, bits = 4, [], n.bit_length()
        key = np.zeros(n, np.int64)
        for j in range(width):
            part = np.zeros(n, np.int64)
            part[: n - j] = data[j:].astype(np.int64) + 1
            key += np.where(left > j, part, 0) << (9 * (width - 1 - j))
        while True:
            if int(key.max()).bit_length() + bits < 64:  # sorting numbers is faster than finding their order
                packed = np.sort(key << bits | np.arange(n))
                order, key = packed & ((1 << bits) - 1), packed >> bits
            else:
                order = np.argsort(key)
                key = key[order]
            rank = np.empty(n, np.int32)
            rank[order] = np.concatenate([[1], 1 + np.cumsum(key[1:] != key[:-1])])
            levels.append((width, rank))
            if width >= size.max():
                break
            key = rank.astype(np.int64) << bits
            key[: n - width] += np.where(left[: n - width] > width, rank[width:], 0)
            width *= 2
        # equal strings in the order of the strings
        suffixes = np.sort((levels[-1][1].astype(np.int64) << 32) + np.arange(n)) & 0xFFFFFFFF
        bwt = np.where(left[suffixes] == size[np.searchsorted(ends, suffixes, "right")], -1, data[suffixes - 1].astype(np.int16))
        begins = np.ones(n, bool)
        begins[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == -1)
        first = np.flatnonzero(begins)
        self.heads, self.sizes = bwt[first], np.diff(np.append(first, n))
        self.place = suffixes[first]
        self.before = np.where(first > 0, suffixes[first - 1], -1)
        a, b = self.place.copy(), np.maximum(self.before, 0)
        self.common = np.zeros(len(first), np.int64)
        for step, rank in reversed(levels):
            inside = np.flatnonzero(np.maximum(a, b) < n)
            same = inside[rank[a[inside]] == rank[b[inside]]]
            for x in (a, b, self.common):
                x[same] += step
        for _ in range(levels[0][0] - 1):
            inside = np.flatnonzero(np.maximum(a, b) < n)
            same = inside[data[a[inside]] == data[b[inside]]]
            for x in (a, b, self.common):
                x[same] += 1
        self.common = np.minimum(self.common, np.minimum(left[self.place], left[np.maximum(self.before, 0)]))
        self.common[self.before < 0] = 0
        self.n = n

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """(length, other place) of each place's match with the suffix before it in order, streamed from the samples in the order of the text."""
        order = np.argsort(self.place)
        place = self.place[order]
        gap = np.diff(np.append(place, self.n))
        ahead = np.arange(self.n) - np.repeat(place, gap)
        return np.repeat(self.common[order], gap) - ahead, np.repeat(self.before[order], gap) + ahead


def first_windows(data: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """The places whose window of `length` bytes occurs at no smaller place; windows lie within the strings."""
    size = np.diff(np.concatenate([[0], ends]))
    whole = np.repeat(ends, size) - np.arange(len(data)) >= length
    common, other = RunIndex(data, ends).statistics()
    link = np.where(common >= length, other, np.arange(len(data)))
    while True:
        further = link[link]
        if np.array_equal(further, link):
            break
        link = further
    at = np.flatnonzero(whole)
    lowest = np.arange(len(data))
    np.minimum.at(lowest, link[at], at)
    return at[lowest[link[at]] == at]


def _inverses(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _INVERSE, _U)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out, out=out)


class Segments:
    """The segments of some texts: text, place in it, windows, anchor, and a hash of the bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        """data[offsets[d]:offsets[d + 1]] is text d."""
        found = [np.zeros((5, 0), np.int64)]
        i, last = 0, len(offsets) - 1
        while i < last:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, "right")) - 1)
            begin = int(offsets[i])
            while True:  # one text longer than a chunk goes by pieces that overlap by all but one byte of a window
                end = min(int(offsets[j]), begin + CHUNK_BYTES)
                cut = np.clip(offsets[i : j + 1], begin, end)
                text, place, windows, anchor, bytes_ = self._of(data[begin:end], cut - begin, length)
                found.append(np.stack([text + i, place + (begin - offsets[i] if j == i + 1 else 0), windows, anchor, bytes_]))
                if end == offsets[j]:
                    break
                begin = end - length + 1
            i = j
        self.text, self.place, self.windows, self.anchor, self.bytes = np.concatenate(found, axis=1)

    @staticmethod
    def _of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple:
        n = len(data)
        if n < length:
            return (np.zeros(0, np.int64),) * 5
        inverse = _inverses(n)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[data] * powers(n), dtype=_U)])
            hashes = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: n - ANCHOR + 1])
        # the upper bits of a hash with its place below them: the smallest of these is the first place of the smallest hash
        low = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=_U)
        width, whole = 1, length - ANCHOR + 1
        while 2 * width <= whole:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < whole:
            low = np.minimum(low[: width - whole], low[whole - width :])
        inside = np.ones(len(low), bool)
        for d in offsets[1:-1].tolist():
            inside[max(0, d - length + 1) : d] = False
        at = np.flatnonzero(inside)
        if not len(at):
            return (np.zeros(0, np.int64),) * 5
        where = (low[at] & _PLACES).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = where[1:] != where[:-1]
        first = np.flatnonzero(new)
        start, windows = at[first], np.diff(np.append(first, len(at)))
        with np.errstate(over="ignore"):
            bytes_ = mix((sums[start + windows + length - 1] - sums[start]) * inverse[start] + windows.astype(_U))
        text = np.searchsorted(offsets, start, "right") - 1
        return text, start - offsets[text], windows, mix(hashes[where[first]]).view(np.int64), bytes_.view(np.int64)


def _cut(b: pa.RecordBatch, length: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray, Segments]]:
    """(rows before, rows, bytes, offsets, segments) of a batch by a few megabytes."""
    data, offsets = string_buffers(b.column("text"))
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CUT_BYTES, "right")) - 1)
        mine, cuts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        yield i, b.slice(i, j - i), mine, cuts, Segments(mine, cuts, length)
        i = j


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


class Bits:
    """A table of bits for the keys of some rows: a key that is in them has its bit set, others seldom."""

    def __init__(self, keys: DataFrame):
        """keys: one column of longs that are well spread."""
        name = keys.columns[0]
        self.slots = min(SLOTS[1], max(SLOTS[0], 1 << (8 * keys.count()).bit_length()))
        table = np.zeros(self.slots // 8, np.uint8)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(self.slots, bool)
            for b in batches:
                bits[self._slot(b.column(name).to_numpy())] = True
            yield _batch(bits=pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()))

        for row in keys.coalesce(8).mapInArrow(tidy(run), "bits binary").collect():  # eight tables at most
            table |= np.frombuffer(row["bits"], np.uint8)
        self.shared = keys.sparkSession.sparkContext.broadcast(table)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys & (self.slots - 1)

    def reader(self):
        """keys -> whether their bits are set, for use in tasks."""
        shared, most = self.shared, self.slots - 1

        def has(keys: np.ndarray) -> np.ndarray:
            slot = keys & most
            return ((shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)

        return has


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for *_, s in _cut(b, length):
                yield _batch(anchor=s.anchor)

    return run


def _places(repeated, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, rows, _, _, s in _cut(b, length):
                k = np.flatnonzero(repeated(s.anchor))
                at, rid = rows.column("at").to_numpy(), rows.column("rid").to_numpy()
                yield _batch(anchor=s.anchor[k], bytes=s.bytes[k], at=at[s.text[k]], rid=rid[s.text[k]], place=s.place[k].astype(np.int32), windows=s.windows[k].astype(np.int32))

    return run


def _place_key(rid: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(rid.view(_U) ^ mix(place.astype(np.int64).view(_U))).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _batch(key=_place_key(b.column("rid").to_numpy(), b.column("place").to_numpy()))


def _texts_of(wanted, length: int):
    """The bytes of the segments at wanted places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, rows, data, offsets, s in _cut(b, length):
                at, rid = rows.column("at").to_numpy()[s.text], rows.column("rid").to_numpy()[s.text]
                k = np.flatnonzero(wanted(_place_key(rid, s.place)))
                first = offsets[s.text[k]] + s.place[k]
                size = s.windows[k] + length - 1
                ends = np.cumsum(size)
                take = np.repeat(first - ends + size, size) + np.arange(size.sum())
                piece = pa.Array.from_buffers(pa.large_binary(), len(k), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data[take])])
                yield _batch(at=at[k], rid=rid[k], place=s.place[k].astype(np.int32), piece=piece.cast(pa.binary()))

    return run


_RANGES = "at long, rid long, low int, high int"


def _ranges(at: np.ndarray, rid: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Places in order of text, as ranges low <= place < high."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (rid[1:] != rid[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return _batch(at=at[first], rid=rid[first], low=place[first].astype(np.int32), high=(place[last] + 1).astype(np.int32))


def _indexed(length: int):
    """Rows in order of anchor: the windows that come first, from one index for each block of whole anchors."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[1:4])
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        size = np.array([len(r[4]) for r in rows])
        ends = np.cumsum(size)
        at, rid, place = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        stay = first_windows(data, ends, length)
        row = np.searchsorted(ends, stay, "right")
        return _ranges(at[row], rid[row], place[row] + stay - (ends - size)[row])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        total, last = 0, None
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("anchor", "at", "rid", "place", "piece"))):
                if total >= INDEX_BYTES and r[0] != last:
                    yield block(rows)
                    rows, total = [], 0
                rows.append(r)
                total += len(r[4])
                last = r[0]
        if rows:
            yield block(rows)

    return run


def _windows(length: int):
    """Two hashes of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pieces = b.column("piece").to_pylist()
            for at, rid, place, piece in zip(*(b.column(c).to_pylist() for c in ("at", "rid", "place")), pieces):
                data = np.frombuffer(piece, np.uint8)
                inverse, n = _inverses(len(data)), len(data) - length + 1
                two = []
                with np.errstate(over="ignore"):
                    for sign in (_BYTE[data], mix(_BYTE[data])):
                        sums = np.concatenate([np.zeros(1, _U), np.cumsum(sign * powers(len(data)), dtype=_U)])
                        two.append(mix((sums[length:] - sums[:-length]) * inverse[:n]).view(np.int64))
                yield _batch(w1=two[0], w2=two[1], at=np.full(n, at), rid=np.full(n, rid), place=(place + np.arange(n)).astype(np.int32))

    return run


_CUT = "at long, rid long, doc_id long, n_bytes long, text string, places array<int>, windows array<int>"


def _with_places(repeated, length: int):
    """Every row with its segments that have repeated anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, rows, _, offsets, s in _cut(b, length):
                k = np.flatnonzero(repeated(s.anchor))
                ptr = pa.array(np.searchsorted(s.text[k], np.arange(rows.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ptr, pa.array(x[k], pa.int32())) for x in (s.place, s.windows)]
                yield _batch(at=rows.column("at"), rid=rows.column("rid"), doc_id=rows.column("doc_id"), n_bytes=np.diff(offsets), text=rows.column("text"), places=lists[0], windows=lists[1])

    return run


_OUT = "doc_id long, n_bytes long, spans array<struct<low:int, high:int>>, kept binary"


def _kept(length: int):
    """What stays of each text, and the spans that go; a row that is there several times goes whole but once."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "n_bytes", "text", "places", "windows", "copies", "first")
        for b in batches:
            for i in range(0, b.num_rows, 64):
                out = []
                for doc_id, n, text, places, windows, copies, first in zip(*(b.column(c).slice(i, 64).to_pylist() for c in names)):
                    data = np.frombuffer((text or "").encode(), np.uint8)
                    spans = []
                    if places:
                        change = np.zeros(n + 1, np.int32)
                        np.add.at(change, places, 1)
                        np.add.at(change, np.add(places, windows), -1)
                        goes = np.cumsum(change) > 0
                        for r in first or ():
                            goes[r["low"] : r["high"]] = False
                        seen = np.concatenate([np.zeros(length, np.int32), np.cumsum(goes[:n], dtype=np.int32)])
                        covered = seen[length:] > seen[:-length]
                        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
                        spans = [{"low": x, "high": y} for x, y in edges.reshape(-1, 2).tolist()]
                        data = data[~covered]
                    out.append((doc_id, n, spans, data.tobytes()))
                    again = (doc_id, n, [{"low": 0, "high": n}], b"") if n >= length else out[-1]
                    for k in range(0, copies - 1, OUT_ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[again] * min(OUT_ROWS, copies - 1 - k)), schema)], schema=schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, the spans of bytes that go (low, high) and the bytes that stay, of every row. length: more than ANCHOR."""
    rid = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("at"), rid.alias("rid"), F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    anchors = docs.select("text").mapInArrow(tidy(_anchors(length)), "anchor long").groupBy("anchor").count().where("count > 1").select("anchor")
    anchors = written(anchors, "anchors")
    repeated = Bits(anchors).reader()
    discard(anchors)

    places = docs.select("at", "rid", "text").mapInArrow(tidy(_places(repeated, length)), "anchor long, bytes long, at long, rid long, place int, windows int")
    segments = places.groupBy("anchor", "bytes").agg(F.min(F.struct("at", "rid", "place")).alias("f"), F.max("windows").alias("windows"))
    segments = written(segments.select("anchor", "f.*", "windows"), "segments")
    kinds = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    segments_of = join_by_hot_keys(segments, kinds, "anchor", F.col("kinds") * HOT_PARTS > segments.count(), "kinds")
    several = written(segments_of.where("kinds > 1").select("at", "rid", "place", "anchor", (F.col("kinds") > MOST_SEGMENTS).alias("hot")), "several")
    wanted = Bits(several.select("rid", "place").mapInArrow(tidy(_keys), "key long")).reader()
    texts = docs.select("at", "rid", "text").mapInArrow(tidy(_texts_of(wanted, length)), "at long, rid long, place int, piece binary")
    # a row that is there several times gives its segments again
    texts = written(texts.join(several, ["at", "rid", "place"]).dropDuplicates(["at", "rid", "place"]), "texts")

    alone = segments_of.where("kinds = 1").select("at", "rid", F.col("place").alias("low"), (F.col("place") + F.col("windows")).alias("high"))
    indexed = texts.where("not hot").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(tidy(_indexed(length)), _RANGES)
    windows = texts.where("hot").mapInArrow(tidy(_windows(length)), "w1 long, w2 long, at long, rid long, place int")
    windows = windows.groupBy("w1", "w2").agg(F.min(F.struct("at", "rid", "place")).alias("f")).select("f.at", "f.rid", F.col("f.place").alias("low"), (F.col("f.place") + 1).alias("high"))
    first = alone.unionByName(indexed).unionByName(windows).groupBy("at", "rid").agg(F.collect_list(F.struct("low", "high")).alias("first"))  # a text has as many as it is long

    cut = docs.mapInArrow(tidy(_with_places(repeated, length)), _CUT)
    once = cut.groupBy("at", "rid").agg(F.count(F.lit(1)).alias("copies"), F.first(F.struct("doc_id", "n_bytes", "text", "places", "windows")).alias("row"))
    return once.join(first, ["at", "rid"], "left").select("row.*", "copies", "first").mapInArrow(tidy(_kept(length)), _OUT)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["high"] - s["low"])
    return remove_repeats(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
