"""The trie of conversation prefixes, by Patricia construction (operator 12).

Every conversation is a sequence of turns (role, text); a node of depth d stands for a distinct sequence of the first d turns,
its members are the conversations that start with it.

1. Equal conversations become one sequence. Their ids are joined in order by pieces of at most PIECE ids, made where a range of
   (sequence, id) lies, and the pieces of a sequence are hashed one after another, so a sequence that a third of all
   conversations share costs one task only its pieces.
2. The sequences are sorted, by ranges of whole sequences: a hot first turn is many ranges. Neighbouring ranges agree in a number
   of turns, one integer for each range, which every task gets.
3. In its range a task goes along the sorted sequences with a stack of points: ends, leaves and branches. Edges in between are
   compressed. A point's members, leaves and sums of bytes are complete when the stack leaves it; the nodes of the edge above
   it then follow by sums along the edge, from its lower end.
4. A node on the path into a neighbouring range has a part in each range (a node, and a child of it, belongs to the range where it
   comes first); these parts, as many as the shared paths are deep, are added up.

Saved bytes are the difference of two sums over a subtree: bytes times members, and bytes once for each node.

Defined results: rows without conv_id belong to no conversation; a null role or text is empty; turns are ordered by turn (null
first), ties by role and by the hash of role and text; repeated rows are turns like any other; conversations whose own turns are all replaced by an
absent one's are turnless and end in the root; other columns are ignored; no rows give no nodes. A very long text costs its hash
only; a task holds a range of sequences, with 32 bytes a turn, so one conversation's turns have to fit a task. Different turns
share a hash of 128 bits with a chance of about (number of turns)^2 / 2^129.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrowtext import tidy
from .session import discard, use_checkpoints, written

#: Ids that are joined to one piece of text.
PIECE = 4096
#: Rows that a task gives out at once.
OUT_ROWS = 5000
#: Conversations that share first turns in `rebuilt`, and one more than most turns they share.
FAMILY, HEAD = 5, 9

_PIECES = "sequence string, first long, n long, piece string"
_ENDS = "sequence string, n long, low long, ends string"
_NODES = "pid int, node binary, parent binary, depth long, n long, low long, kids long, leaves long, weighed long, once long, ends string, shared boolean, parent_low long, parent_shared boolean"
_NODE_NAMES = [x.split()[0] for x in _NODES.split(", ")]


def turns_of(talks: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as structs of k (a hash of role and text) and size (bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    k = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    one = F.struct(F.col("turn"), role.alias("role"), k.alias("k"), F.octet_length(text).cast("long").alias("size"))
    per = talks.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return per.select("conv_id", F.transform("turns", lambda t: F.struct(t["k"], t["size"])).alias("turns"))


def rebuilt(talks: DataFrame) -> DataFrame:
    """turns_of, where the first h turns are those of conversation c - c % 5 (fewer if it has fewer); h = crc32(c) % 9."""
    own = turns_of(talks)
    heads = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEAD)).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).join(heads, "base", "left")
    rest = F.slice("turns", h + 1, F.size("turns"))
    return both.select("conv_id", F.when(F.col("head").isNull(), rest).otherwise(F.concat(F.slice("head", F.lit(1), h), rest)).alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of sequence and id: of each sequence the ids here, joined."""
    last, ids, out = None, [], []

    def close() -> None:
        if ids:
            out.append((last, ids[0], len(ids), ",".join(map(str, ids))))
            ids.clear()

    def table() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pylist([dict(zip(("sequence", "first", "n", "piece"), r)) for r in out], pa.schema([("sequence", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("piece", pa.string())]))
        out.clear()
        return made

    for b in batches:
        for sequence, conv in zip(b.column("sequence").to_pylist(), b.column("conv_id").to_pylist()):
            if sequence != last or len(ids) == PIECE:
                close()
                last = sequence
            ids.append(conv)
        yield table()
    close()
    yield table()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of sequence and first id: members, smallest id and hash of each sequence, one piece after another."""
    last, low, n, digest, out = None, 0, 0, None, []
    names = [x.split()[0] for x in _ENDS.split(", ")]

    def table() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], pa.schema([("sequence", pa.string()), ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())]))
        out.clear()
        return made

    for b in batches:
        for sequence, first, count, piece in zip(*(b.column(c).to_pylist() for c in ("sequence", "first", "n", "piece"))):
            if sequence != last:
                if digest is not None:
                    out.append((last, n, low, digest.hexdigest()))
                last, low, n, digest = sequence, first, 0, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
            n += count
        yield table()
    if digest is not None:
        out.append((last, n, low, digest.hexdigest()))
    yield table()


class _Point:
    """An end, a leaf or a branch, with sums over what lies below it; waiting: rows of children that need its smallest member."""

    __slots__ = ("depth", "n", "low", "kids", "below", "leaves", "weighed", "once", "ends", "waiting")

    def __init__(self, depth: int):
        self.depth, self.n, self.low, self.kids, self.below, self.leaves, self.weighed, self.once, self.ends, self.waiting = depth, 0, None, 0, 0, 0, 0, 0, None, []

    def take(self, n: int, low: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)


class _Range:
    """The part of the trie in one range of sorted sequences. before, after: turns that the neighbouring ranges share with it, -1 without one."""

    def __init__(self, pid: int, before: int, after: int):
        self.pid, self.before, self.after = pid, before, after
        self.stack, self.done = [_Point(0)], []
        self.keys, self.sizes, self.ids = [], [], [hashlib.md5(b"").digest()]
        self.like_first: int | None = None  # turns that the path shares with the range's first sequence

    def add(self, keys: list[str], sizes: list[int], n: int, low: int, ends: str) -> None:
        common = 0
        for a, b in zip(self.keys, keys):
            if a != b:
                break
            common += 1
        self._close(common, False)
        self.like_first = len(keys) if self.like_first is None else min(self.like_first, common)
        del self.ids[common + 1 :]
        for k in keys[common:]:
            self.ids.append(hashlib.md5(self.ids[-1] + k.encode()).digest())
        self.keys, self.sizes = keys, sizes
        if len(keys) > self.stack[-1].depth:
            self.stack.append(_Point(len(keys)))
        self.stack[-1].take(n, low)
        self.stack[-1].ends = ends

    def finish(self) -> None:
        self._close(-1, True)

    def _close(self, common: int, at_end: bool) -> None:
        """The points deeper than `common` are complete; at_end: they are on the path to the next range."""
        while self.stack and self.stack[-1].depth > common:
            p = self.stack.pop()
            if common > (self.stack[-1].depth if self.stack else -1) and common >= 0:
                self.stack.append(_Point(common))
            self._edge(p, self.stack[-1] if self.stack else None, at_end)

    def _own(self, depth: int) -> bool:
        """Whether the node of this depth on the path comes first in this range."""
        return depth > min(self.like_first, self.before)

    def _edge(self, p: _Point, up: _Point | None, at_end: bool) -> None:
        """Gives out p and the nodes between it and the point above, from below."""
        if not p.below and not (at_end and self.after >= p.depth):
            p.leaves = 1
        weighed, once, top = p.weighed, p.once, up.depth + 1 if up else 0
        child = None
        for d in range(p.depth, top - 1, -1):
            own = self._own(d)
            size = self.sizes[d - 1] if d else 0
            weighed += p.n * size
            once += size if own else 0
            kids = p.kids if d == p.depth else int(self._own(d + 1))
            shared = not own or (at_end and d <= self.after)
            row = [self.pid, self.ids[d], self.ids[d - 1] if d else None, d, p.n, p.low, kids, p.leaves, weighed, once, p.ends if d == p.depth else None, shared, None, False]
            for waits in p.waiting if d == p.depth else [child]:
                waits[-2:] = p.low, shared
                self.done.append(waits)
            child = row
        if up is None:
            self.done.append(child)
            return
        up.waiting.append(child)
        up.take(p.n, p.low)
        up.below += 1
        up.kids += int(self._own(top))
        up.leaves += p.leaves
        up.weighed += weighed
        up.once += once


def _trie(shared_turns: dict[int, tuple[int, int]]):
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _NODES.split(", ")])

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for b in batches:
            for pid, keys, sizes, n, low, ends in zip(*(b.column(c).to_pylist() for c in ("pid", "keys", "sizes", "n", "low", "ends"))):
                part = part or _Range(pid, *shared_turns[pid])
                part.add(keys, sizes, n, low, ends)
                if len(part.done) >= OUT_ROWS:
                    yield table(part.done)
                    part.done.clear()
        if part:
            part.finish()
            yield table(part.done)

    return run


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last sequence of a range."""
    first = last = None
    for b in batches:
        if b.num_rows:
            first = first or b.slice(0, 1)
            last = b.slice(b.num_rows - 1, 1)
    if first:
        yield pa.RecordBatch.from_arrays([first.column("pid"), first.column("keys"), last.column("keys")], names=["pid", "first", "last"])


def _common(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from their start."""
    short = F.least(F.size(a), F.size(b))
    return F.array_min(F.filter(F.sequence(F.lit(0), short), lambda i: (i == short) | (F.get(a, i) != F.get(b, i))))


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences (conv_id, turns as in turns_of, once for each conv_id): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and node and parent, which tell nodes apart."""
    spark = sequences.sparkSession
    use_checkpoints(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = F.transform("turns", lambda t: t["k"])
    whole = written(sequences.select("conv_id", keys.alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"), F.md5(F.array_join(keys, "")).alias("sequence")), "sequences")
    pieces = whole.select("sequence", "conv_id").repartitionByRange(ranges, "sequence", "conv_id").sortWithinPartitions("sequence", "conv_id").mapInArrow(tidy(_pieces), _PIECES)
    ends = pieces.repartition("sequence").sortWithinPartitions("sequence", "first").mapInArrow(tidy(_joined), _ENDS)
    distinct = whole.join(ends, (whole["sequence"] == ends["sequence"]) & (F.col("conv_id") == F.col("low"))).select("keys", "sizes", "n", "low", "ends")
    ranged = distinct.repartitionByRange(ranges, "keys").sortWithinPartitions("keys").withColumn("pid", F.spark_partition_id()).checkpoint()

    outer = written(ranged.select("pid", "keys").mapInArrow(tidy(_outer), "pid int, first array<string>, last array<string>"), "outer")
    pids = sorted(r.pid for r in outer.select("pid").collect())  # as many as ranges
    after = dict.fromkeys(pids, -1)
    if len(pids) > 1:
        follows = spark.createDataFrame(list(zip(pids, pids[1:])), "pid int, next int")
        met = outer.select("pid", "last").join(follows, "pid").join(outer.select(F.col("pid").alias("next"), "first"), "next")
        after |= {r.pid: r.common for r in met.select("pid", _common(F.col("last"), F.col("first")).alias("common")).collect()}
    before = dict(zip(pids[1:], (after[p] for p in pids)))
    nodes = written(ranged.mapInArrow(tidy(_trie({p: (before.get(p, -1), after[p]) for p in pids})), _NODES), "nodes")
    discard(whole, outer)

    # nodes that several ranges have a part in; their parents are such nodes, too
    parts = nodes.where("shared")
    merged = parts.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "weighed", "once")], F.min("low").alias("low"), F.max("ends").alias("ends"))
    merged = written(merged, "merged")
    named = merged.select(F.col("node").alias("parent"), F.col("low").alias("parent_low"))
    here = parts.select("pid", "node").join(merged.select("node", "low"), "node").select("pid", F.col("node").alias("parent"), F.col("low").alias("parent_low"))
    cols = ["node", "parent", "depth", "n", "kids", "leaves", "weighed", "once", "low", "ends", "parent_low"]
    own = nodes.where("not shared")
    below = own.where("parent_shared").drop("parent_low").join(here, ["pid", "parent"])  # a parent has no more rows here than its range
    out = own.where("not parent_shared").select(cols).unionByName(below.select(cols)).unionByName(merged.join(named, "parent", "left").select(cols))
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("weighed") - F.col("once")).alias("saved_tokens"), F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"), "node", "parent")
