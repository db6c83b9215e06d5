"""Byte-level BPE encoding and decoding, words folded in higher-order functions (operator 3).

The ranks of all pairs of pieces that together are a piece are one row of numbers, which comes as a broadcast table of one row (a literal would be
written out in the text of each plan, and the driver keeps these texts). A word is folded over its bytes: as long as a pair of neighbours has a rank, the lowest one is
merged, the leftmost first; a part, its place and the rank of its pair are one number, and only the two pairs beside a merge
are looked up anew. A word that is a piece itself is not folded.

Distinct words are folded, not their uses. The most used ones of a bounded, hash-chosen sample of texts are folded
ahead, and their ids go to the workers that cut texts into words. Of the others, those of a block of texts
(BLOCK_BYTES, or one longer text) become one array in which each is once, and the same expression folds that array;
the second pass over the block puts their ids in place. So the sample changes the time and never a result, a block
needs as many folds as it has unseen words at any size of the table, and nothing is shuffled but the sample's counts.

A text's ids are a string with one letter (code point) for each id, which UTF-16 turns into their
little-endian integers; decoding looks up the bytes of each id and concatenates them, for many ids at once.

Defined results: a null text is empty (no ids, empty bytes); a null doc_id stays null; repeated rows each give a row; a
very long text is a block of its own, cut into words in pieces; other columns are ignored; no rows give no rows. The
vocabulary can have up to 55,296 ids.
"""

from __future__ import annotations

import base64
import collections
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .arrowtext import chunks, string_buffers, tidy
from .session import discard, small_batches, written
from .token_count import WordCutter

#: Texts whose words are folded ahead (in expectation), and the most words of them.
SAMPLE_DOCS, MAX_WORDS = 50_000, 650_000
#: Bytes of texts whose other words are folded together.
BLOCK_BYTES = 4 << 20
#: Ids of texts that are decoded at once (one longer text goes alone).
ROW_IDS = 1 << 17
#: Ids must stay below the first code point that is no letter of its own; OTHER stands for a word that is folded later.
MAX_IDS, OTHER = 0xD800, "\ue000"
#: A part of a word is one long: the rank of the pair it begins (the code of what they are together), the place of its first byte, its code.
CODE_BITS, RANK_SHIFT = 16, 46
NO_RANK = 1 << 16
#: Groups of pairs (a prime that divides no width), how far a group can be moved on, and widths of the row of pairs.
GROUPS, MOVES, WIDTHS = 30_011, 1 << 13, (300_007, 600_011, 1_200_007)
NO_PAIR = NO_RANK << RANK_SHIFT
#: What a word is folded by: ranks of pairs, what groups of pairs are moved on by, codes of bytes, letters of codes.
TABLES = "row", "moved", "single", "letters"


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with one base64 piece and its rank a line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    if max(ranks.values()) >= MAX_IDS or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"needs ids below {MAX_IDS} and a rank for every byte")
    return ranks


class PairTable:
    """The rank of every pair of pieces that together are a piece, in one row of numbers.

    A piece's code is its id and 1; 0 is no piece. A pair is left << 16 | right, its place its remainder by `width`, moved on by what all
    pairs of its group (the remainder by GROUPS) are moved on, so that no two share a place. The row has pair << 16 | joined there.
    """

    def __init__(self, ranks: dict[bytes, int]):
        found = {(ranks[k[:i]] + 1) << 16 | (ranks[k[i:]] + 1): v + 1 for k, v in ranks.items() for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks}
        pairs = np.array(list(found), np.int64)
        self.width = next(w for w in WIDTHS if w >= 2 * len(pairs))  # GROUPS times that is beyond all pairs, so those of a group have different remainders
        group, place = pairs % GROUPS, pairs % self.width
        order = np.argsort(group, kind="stable")
        groups, first, many = np.unique(group[order], return_index=True, return_counts=True)
        free, self.moved, on = np.ones(self.width + MOVES, bool), np.zeros(GROUPS, np.int64), np.random.default_rng(0).permutation(MOVES)
        for k in np.argsort(-many, kind="stable").tolist():
            mine = place[order[first[k] : first[k] + many[k]]]
            for i in range(0, MOVES, 64):
                fits = np.flatnonzero(free[on[i : i + 64, None] + mine].all(axis=1))
                if len(fits):
                    break
            self.moved[groups[k]] = on[i + fits[0]]
            free[on[i + fits[0]] + mine] = False
        self.row = np.zeros(self.width + MOVES, np.int64)
        self.row[self.moved[group] + place] = pairs << 16 | np.array(list(found.values()), np.int64)

    def rank(self, table: dict[str, Column], left: Column, right: Column) -> Column:
        """The code of the piece that two are together; NO_RANK if they are none: then the row has another pair, which leaves more than 16 bits."""
        pair = F.shiftleft(left, 16).bitwiseOR(right)
        return F.least(F.get(table["row"], (F.get(table["moved"], (pair % GROUPS).cast("int")) + pair % self.width).cast("int")).bitwiseXOR(F.shiftleft(pair, 16)), F.lit(NO_RANK))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _code(part: Column) -> Column:
    return part.bitwiseAND(F.lit((1 << CODE_BITS) - 1))


def _part(rank: Column, rest: Column) -> Column:
    return F.shiftleft(rank, RANK_SHIFT).bitwiseOR(rest)


class Codec:
    """Expressions that encode and decode by one vocabulary."""

    def __init__(self, spark: SparkSession, path: str):
        ranks = read_ranks(path)
        self.spark = spark
        self.pairs = PairTable(ranks)
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.pieces[v] = k
        letters = [chr(i) for i in range(len(self.pieces))]
        single = [ranks[bytes([b])] + 1 for b in range(256)]
        arrays = pa.array(self.pairs.row), pa.array(self.pairs.moved.astype(np.int32)), pa.array(single), pa.array(["", *letters])
        self.tables = spark.createDataFrame(pa.table({f"table_{c}": pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for c, x in zip(TABLES, arrays)}))
        whole = {w: v for k, v in ranks.items() if (w := k.decode("utf-8", "ignore")).encode() == k}
        self.whole = _pack(pa.RecordBatch.from_arrays([pa.array(list(whole)), pa.array([letters[v] for v in whole.values()])], names=["word", "ids"]))

    def _merge(self, table: dict[str, Column], state: Column) -> Column:
        """The state after its lowest-ranked pair, the leftmost one, is merged."""

        def merged(low: Column, at: Column) -> Column:
            joined = F.shiftright(low, RANK_SHIFT)
            before, after = F.get(state, at - 2), F.get(state, at + 1)
            new = F.array(
                _part(self.pairs.rank(table, _code(before), joined), before.bitwiseAND(F.lit((1 << RANK_SHIFT) - 1))),
                _part(self.pairs.rank(table, joined, _code(after)), low.bitwiseAND(F.lit((1 << RANK_SHIFT) - (1 << CODE_BITS))).bitwiseOR(joined)),
            )
            return F.flatten(F.array(F.slice(state, F.lit(1), at - 2), new, F.slice(state, at + 2, F.lit(1 << 30))))

        return _let(F.array_min(state), lambda low: F.when(low >= NO_PAIR, state).otherwise(_let(F.array_position(state, low).cast("int"), lambda at: merged(low, at))))

    def encode_words(self, rows: DataFrame, words: str) -> DataFrame:
        """The rows, with the ids of each word, as letters, in place of an array of words. A row meets a copy of the tables, so it should have many words."""

        def bound(table: dict[str, Column]) -> Column:
            """Each array is taken from the row once, not at each look-up."""
            if len(table) < len(TABLES):
                name = TABLES[len(table)]
                return _let(F.col(f"table_{name}"), lambda x: bound(table | {name: x}))
            return F.transform(words, lambda w: self._encode(table, w))

        return rows.crossJoin(F.broadcast(self.tables)).select(*[bound({}).alias(c) if c == words else c for c in rows.columns])

    def _encode(self, table: dict[str, Column], word: Column) -> Column:

        def fold(codes: Column) -> Column:
            parts = F.transform(codes, lambda c, i: _part(self.pairs.rank(table, c, F.get(codes, i + 1)), F.shiftleft(i.cast("long"), CODE_BITS).bitwiseOR(c)))
            end = F.array(F.lit(NO_PAIR))  # no piece, on both sides, so that every pair has two neighbours
            return F.aggregate(F.slice(codes, F.lit(2), F.lit(1 << 30)), F.concat(end, parts, end), lambda s, _: self._merge(table, s))

        latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
        folded = _let(F.transform(F.split(latin, ""), lambda c: F.get(table["single"], F.ascii(c))), fold)
        return F.array_join(F.transform(folded, lambda p: F.get(table["letters"], _code(p).cast("int"))), "")

    def fold_ahead(self, docs: DataFrame, most: int) -> list[bytes]:
        """The `most` distinct words of a bounded sample of texts with their ids, packed by the executors."""
        share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
        chance = F.pmod(F.xxhash64(F.lit(41), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
        used = written(docs.where(chance < share).select("text").mapInArrow(tidy(_word_counts), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
        # the most used words that are not too many: a table of counts of counts says from how many uses on
        left, least = most, 1 << 62
        for n, words in used.groupBy("n").count().orderBy(F.desc("n")).collect():
            left -= words
            if left < 0:
                break
            least = n
        folded = self.encode_words(used.where(F.col("n") >= least).select("word").mapInArrow(_gathered, "word array<string>, ids array<string>"), "ids")
        packed = [bytes(r["packed"]) for r in folded.mapInArrow(tidy(_packed), "packed binary").collect()]
        discard(used)
        return packed

    def encode(self, docs: DataFrame, ahead: int = MAX_WORDS) -> DataFrame:
        """One row a block of texts: their doc_ids, and what _ids_and_bytes() needs to put their ids together."""
        shared = self.spark.sparkContext.broadcast([*self.fold_ahead(docs, ahead), self.whole])
        return self.encode_words(docs.mapInArrow(tidy(_cut_blocks(shared)), BLOCK), "others")


def _pack(b: pa.RecordBatch) -> bytes:
    """Words and ids as compressed bytes, so that the driver holds no objects for them."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(b)
    return sink.getvalue().to_pybytes()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a batch in one row, twice: one array gives way to their ids."""
    for b in batches:
        words = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("word").cast(pa.string()))
        yield pa.RecordBatch.from_arrays([words, words], names=["word", "ids"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        flat = pa.RecordBatch.from_arrays([b.column(c).flatten() for c in ("word", "ids")], names=["word", "ids"])
        yield pa.RecordBatch.from_arrays([pa.array([_pack(flat)], pa.binary())], names=["packed"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = WordCutter()
    for b in batches:
        text = b.column("text")
        _, offsets = string_buffers(text)
        for i, j in chunks(offsets):
            n = collections.Counter()
            for t in text.slice(i, j - i).to_pylist():
                for words in cutter.pieces(t):
                    n.update(words)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])


#: doc_ids, letters (OTHER for a use of a word not folded ahead) of the texts of a block, the words of these uses as 32-bit
#: places in others, and others: those words, each once (its letters after they are folded).
BLOCK = "doc_id array<long>, letters array<string>, uses binary, others array<string>"


def _cut_blocks(shared):
    """Cuts texts into words: letters where they are folded ahead, OTHER where not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = WordCutter(), {}
        for packed in shared.value:
            for b in pa.ipc.open_stream(pa.py_buffer(packed)):
                known.update(zip(b.column("word").to_pylist(), b.column("ids").to_pylist()))
        for b in batches:
            text = b.column("text")
            _, offsets = string_buffers(text)
            for i, j in chunks(offsets, BLOCK_BYTES):
                letters, uses, others = [], array("i"), {}
                for k in range(i, j):
                    parts = []
                    for words in cutter.pieces(text[k].as_py()):
                        found = list(map(known.get, words))
                        if None in found:
                            uses.extend([others.setdefault(w, len(others)) for w, x in zip(words, found) if x is None])
                            found = [OTHER if x is None else x for x in found]
                        parts.append("".join(found))
                    letters.append("".join(parts))
                row = [b.column("doc_id").slice(i, j - i).to_pylist()], [letters], [uses.tobytes()], [list(others)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.list_(pa.string())))], names=["doc_id", "letters", "uses", "others"])

    return run


def _utf16(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-16-le"), "<u2")


def _letter_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """offsets, counted in letters: a letter begins at every byte that goes on no letter."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]


def _filled(letters: pa.Array, uses: np.ndarray, others: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts of a block, end of each text, from 0): every OTHER gives way to the ids of its word."""
    data, offsets = string_buffers(letters)
    ids, ends = _utf16(data), _letter_ends(data, offsets)
    if len(uses):
        raw, cuts = string_buffers(others)
        pool, cuts = _utf16(raw), _letter_ends(raw, cuts)
        start, size = cuts[uses], np.diff(cuts)[uses]
        at = np.flatnonzero(ids == ord(OTHER))
        long = np.ones(len(ids), np.int64)
        long[at] = size
        to = np.concatenate([[0], np.cumsum(long)])
        out = np.repeat(ids, long)
        out[np.repeat(to[at], size) + _ramp(size)] = pool[np.repeat(start, size) + _ramp(size)]
        ids, ends = out, to[ends]
    return ids, ends


def _ramp(size: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _ids_and_bytes(pieces: list[bytes]):
    """Letters as little-endian integers, and the pieces of those integers put together again."""
    pool = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces], np.int64)
    start = np.cumsum(size) - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                doc_id, letters, others = (b.column(c).slice(k, 1).flatten() for c in ("doc_id", "letters", "others"))
                ids, ends = _filled(letters, np.frombuffer(b.column("uses")[k].as_py(), np.int32), others)
                for i, j in chunks(ends, ROW_IDS):
                    some, own = ids[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
                    long = size[some]
                    to = np.concatenate([[0], np.cumsum(long)])
                    text = pool[np.repeat(start[some], long) + _ramp(long)]
                    yield pa.RecordBatch.from_arrays([doc_id.slice(i, j - i), pa.array(np.diff(own)), _binaries(some.astype("<u4").view(np.uint8), 4 * own), _binaries(text, to[own])], names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def encode_and_decode(docs: DataFrame, vocabulary: str, ahead: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded (bytes) of every row.

    Each worker holds at most `ahead` words that are folded ahead (about 250 bytes a word): fewer take less memory and more time.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    codec = Codec(docs.sparkSession, vocabulary)
    return codec.encode(docs).mapInArrow(tidy(_ids_and_bytes(codec.pieces)), "doc_id long, n_tokens long, ids binary, decoded binary")
