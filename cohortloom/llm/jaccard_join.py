"""N-gram Jaccard join by a token-group matrix (operator 9).

A text's set is its distinct word shingles, as 64-bit hashes. Texts with equal sets are one class from
the start. Two classes link when 100 * intersection >= 75 * union.

Tokens have one order for all texts: those that are common in a sample come last, the rest by hash. Two
linked sets of a and b tokens share a token among the first n - ceil(0.75 n) + 1 of each, and at the
first one they share, the tokens that follow must still allow an overlap of 3 (a + b) / 7. Any order
gives the same links; the sample only makes rare tokens come first.

1. Grouping. Every class goes to its leading tokens; tokens that one class alone has are dropped. In
   each token's list the classes are compared with one of its classes only, by exact overlap. What is
   linked so far partitions the texts into groups of similar ones.
2. Token-group matrix. For every leading token and group: the largest number of tokens that can still
   follow in a member, and the sizes of the members, so the union of the group's leading tokens with
   what bounds an overlap. A class asks the groups that have one of its tokens; where the bound for
   the whole group is too low, the group stays closed. Only members of opened groups, and of other
   groups than the asking one, become pairs, and are compared by exact overlap.

So all links between groups are found, links within a group need not be, and components are exact.
Pairs never come from all members of a list: a list gives one pair a member in step 1, and in step 2
only pairs between groups that the bounds cannot tell apart.

Defined results: a text with fewer words than a shingle has its whole sequence as its one shingle; null
texts and texts without words have an empty set and are components of their own; repeated rows keep a
row each; a row with a null doc_id links as any other, and a component's id is the smallest doc_id that is not null
(null if there is none); a very long text is one row with all its shingles; other columns are ignored; no rows give no rows. Different sets or shingles share a 64-bit hash with
a chance of about (number of classes)^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrowtext import chunks, distinct_sets, mix, shingles, string_buffers, tidy, Words
from .components import HOT_PARTS, connected_components, join_by_hot_keys
from .session import discard, written

WORDS = 5
#: Share of the texts that common tokens are looked for in, and least texts (in expectation); uses there that make a token
#: common; most common tokens. A share, and not a number of texts, so that a token has as few uses at any size before it is common.
SAMPLE_SHARE, SAMPLE_DOCS, COMMON_USES, MAX_COMMON = 1 / 6, 8000, 3, 1_000_000
#: Classes whose tokens a task has given out already and does not repeat.
SEEN_CLASSES = 200_000
#: Pairs of one class that a task compares with it.
PART_PAIRS = 5000
#: Fewest and most slots of the bit table that keeps most texts out when sets are needed again (eight for each text that is needed);
#: where more are needed, texts are joined without it.
FILTER_SLOTS = 1 << 20, 1 << 27

_U = np.uint64


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_sets(*shingles(Words(data, offsets), k))


def _class_ids(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A hash of each set, whatever its order."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(values ^ _U(0x5DEECE66D)), dtype=_U)])
        return mix((total[ptr[1:]] - total[ptr[:-1]]) * _U(0x9E3779B97F4A7C15) + np.diff(ptr).astype(_U))


def prefix_size(n):
    """Leading tokens of a set of n of which a linked set must have one."""
    return n - -(-3 * n // 4) + 1


class Order:
    """The order of tokens: common ones last, by rising number of uses."""

    def __init__(self, tokens: np.ndarray, uses: np.ndarray):
        by_use = np.lexsort((tokens, uses))
        rank = np.empty(len(tokens), np.int64)
        rank[by_use] = np.arange(len(tokens))
        at = np.argsort(tokens)
        self.tokens, self.rank = tokens[at], rank[at]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(tokens & _U((1 << 22) - 1)).astype(np.int64)] = True

    def prefixes(self, values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading tokens of each set in order, ptr). values ascend within each set."""
        n = np.diff(ptr)
        size = np.where(n > 0, prefix_size(n), 0)
        out = np.concatenate([[0], np.cumsum(size)])
        at = np.flatnonzero(self.maybe[(values & _U((1 << 22) - 1)).astype(np.int64)])
        if len(at) and len(self.tokens):
            slot = np.minimum(np.searchsorted(self.tokens, values[at]), len(self.tokens) - 1)
            hit = self.tokens[slot] == values[at]
            at, slot = at[hit], slot[hit]
            key = values >> _U(1)
            key[at] = _U(1 << 63) + self.rank[slot].astype(_U)
            values = values.copy()
            for d in np.unique(np.searchsorted(ptr, at, "right") - 1).tolist():
                a, b = ptr[d], ptr[d + 1]
                values[a:b] = values[a:b][np.argsort(key[a:b], kind="stable")]
        take = np.repeat(ptr[:-1] - out[:-1], size) + np.arange(out[-1])
        return values[take], out


def _common(docs: DataFrame, k: int) -> Order:
    share = min(1.0, max(SAMPLE_SHARE, SAMPLE_DOCS / max(1, docs.count())))
    chance = F.pmod(F.xxhash64(F.lit(31), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for i, j in chunks(offsets):
                values, _ = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], names=["token"])

    uses = docs.where(chance < share).select("text").mapInArrow(tidy(run), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("uses")).where(F.col("uses") >= COMMON_USES)
    uses = written(uses, "uses")
    # the most used tokens that are not too many, by a table of counts of counts
    left, least = MAX_COMMON, 1 << 62
    for n, tokens in uses.groupBy("uses").count().orderBy(F.desc("uses")).collect():
        left -= tokens
        if left < 0:
            break
        least = n
    found = uses.where(F.col("uses") >= least).toArrow()
    discard(uses)
    return Order(found["token"].to_numpy().view(_U), found["uses"].to_numpy())


def _classified(docs: DataFrame, order: Order, k: int) -> DataFrame:
    """doc_id, text_key, n, class and, once in a task for each class, its leading tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for i, j in chunks(offsets):
                values, ptr = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                ids = _class_ids(values, ptr)
                lead, out = shared.value.prefixes(values, ptr)
                fresh = np.zeros(j - i, bool)
                for d, c in enumerate(ids.tolist()):
                    if c not in seen:
                        seen.add(c)
                        fresh[d] = True
                if len(seen) > SEEN_CLASSES:
                    seen.clear()
                size = np.where(fresh, np.diff(out), 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(lead[np.repeat(fresh, np.diff(out))].view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), b.column("text_key").slice(i, j - i), pa.array(np.diff(ptr)), pa.array(ids.view(np.int64)), lists], names=["doc_id", "text_key", "n", "class", "lead"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(tidy(run), "doc_id long, text_key long, n long, class long, lead array<long>")


_LISTED = "token long, class long, n long, pos int, hub long, hub_n long, hub_pos int"


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of token, place and class: those of tokens with several classes, with the token's first class.

    The first class has the fewest rarer tokens, so it is the likeliest middle of a family of edited copies.
    """
    carry, told = None, False  # the hub of the last token, and whether it was given out
    for b in batches:
        if not b.num_rows:
            continue
        rows = np.stack([b.column(c).to_numpy() for c in ("token", "class", "n", "pos")])
        goes_on = carry is not None and carry[0] == rows[0, 0]
        if carry is not None:
            rows = np.concatenate([carry[:, None], rows], axis=1) if goes_on else rows
        token, cls = rows[0], rows[1]
        new = np.concatenate([[True], token[1:] != token[:-1]])
        distinct = new | np.concatenate([[True], cls[1:] != cls[:-1]])
        starts = np.flatnonzero(new)
        many = np.add.reduceat(distinct.astype(np.int64), starts) > 1
        size = np.diff(np.append(starts, len(token)))
        give = np.repeat(many, size) & distinct
        hub = np.repeat(starts, size)
        if goes_on and told:
            give[0] = False  # it was given out with an earlier batch
        told = bool(many[-1]) or (goes_on and told and len(starts) == 1)
        carry = rows[:, starts[-1]].copy()
        at, hub = np.flatnonzero(give), hub[give]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in ((token[at], np.int64), (cls[at], np.int64), (rows[2, at], np.int64), (rows[3, at], np.int32), (cls[hub], np.int64), (rows[2, hub], np.int64), (rows[3, hub], np.int32))], names=[x.split()[0] for x in _LISTED.split(", ")])


def _possible(n: Column, pos: Column, m: Column, other: Column) -> Column:
    """Whether sets of n and m tokens whose first shared token has these places can link."""
    rest = F.least(n - pos, m - other)
    return (7 * rest >= 3 * (n + m)) & (4 * F.least(n, m) >= 3 * F.greatest(n, m))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The pairs of classes (a, b) that link, by the exact overlap of their sets.

    Texts travel rather than sets, which are four times as large: each b goes to its a, and each a once
    to every part of its pairs. Within a part the texts stream past the set of a.
    """
    spark = docs.sparkSession
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / PART_PAIRS).cast("int"))
    owned = join_by_hot_keys(pairs, sizes, "a", F.col("n") * HOT_PARTS > pairs.count(), "n").withColumn("part", F.pmod(F.hash("b"), "parts"))
    seats = owned.select("a", "part", F.col("b").alias("class")).unionByName(sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("class")))
    used = written(seats.join(classes, "class").select("doc_id", "text_key", "a", "part", "class"), "used")
    slots = max(FILTER_SLOTS[0], 1 << (8 * used.count()).bit_length())
    slot = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(slots))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    if slots <= FILTER_SLOTS[1]:
        table = np.zeros(slots // 8, np.uint8)
        for row in used.select(slot.alias("slot")).coalesce(8).mapInArrow(tidy(_bits(slots)), "bits binary").collect():  # eight tables at most
            table |= np.frombuffer(row["bits"], np.uint8)
        keyed = keyed.withColumn("slot", slot).mapInArrow(tidy(_possible_texts(spark.sparkContext.broadcast(table))), "doc_id long, text_key long, text string")

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            rows = list(zip(b.column("a").to_pylist(), b.column("part").to_pylist(), b.column("class").to_pylist()))
            good = []
            for i, j in chunks(offsets):
                values, ptr = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                for d, (a, part, c) in enumerate(rows[i:j]):
                    mine = values[ptr[d] : ptr[d + 1]]
                    if a == c:
                        key, own = (a, part), mine.copy()
                    elif key == (a, part):
                        both = np.sort(np.concatenate([own, mine]))
                        same = int((both[1:] == both[:-1]).sum())
                        if 100 * same >= 75 * (len(both) - same):
                            good.append((a, c))
                    else:
                        raise ValueError("a pair's first text is missing")
            yield pa.RecordBatch.from_arrays([pa.array([g[x] for g in good], pa.int64()) for x in (0, 1)], names=["a", "b"])

    seats = used.withColumnsRenamed({"doc_id": "used_id", "text_key": "used_key"})
    same = F.col("doc_id").eqNullSafe(F.col("used_id")) & (F.col("text_key") == F.col("used_key"))
    texts = keyed.join(seats, same).select("a", "part", "class", "text")
    ordered = texts.repartition("a", "part").sortWithinPartitions("a", "part", F.col("class") != F.col("a"))
    linked = written(ordered.mapInArrow(tidy(overlaps), "a long, b long").distinct(), "linked")  # a row that is repeated gives its pair again
    discard(used)
    return linked


def _bits(slots: int):
    """Bits that are set at the slots of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(slots, bool)
        for b in batches:
            table[b.column("slot").to_numpy()] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(table, bitorder="little").tobytes()], pa.binary())], names=["bits"])

    return run


def _possible_texts(shared):
    """The rows whose slot is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = b.column("slot").to_numpy()
            mine = (shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1)
            yield b.filter(pa.array(mine != 0)).select(["doc_id", "text_key", "text"])

    return run


def link_groups(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key (hash of the text) and group_id (null without words) of every row."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = written(_classified(docs, _common(docs, k), k), "classified")
    classes = rows.where("n > 0").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.select("class", "first.doc_id", "first.text_key", "low", "copies"), "classes")
    tokens = rows.where("size(lead) > 0").select("class", "n", F.posexplode("lead").alias("pos", "token")).select("token", "class", "n", "pos")
    shared = written(tokens.repartition("token").sortWithinPartitions("token", "pos", "class").mapInArrow(tidy(_shared_tokens), _LISTED), "listed")

    n, pos = F.col("n"), F.col("pos")
    stars = shared.where((F.col("class") != F.col("hub")) & _possible(n, pos, F.col("hub_n"), F.col("hub_pos")))
    # each class is compared with the hub that most of its tokens name
    stars = stars.groupBy(F.col("class").alias("b"), F.col("hub").alias("a")).agg(F.count(F.lit(1)).alias("votes"), (-F.min("hub_pos")).alias("middle"))
    stars = written(stars.groupBy("b").agg(F.max_by("a", F.struct("votes", "middle", "a")).alias("a")).select("a", "b"), "stars")
    links = _verified(stars.select("a", "b"), docs, classes.select("class", "doc_id", "text_key"), k)
    found = written(connected_components(links), "groups")
    groups = found.select(F.col("id").alias("class"), F.col("component").alias("group"))

    # the matrix of leading tokens by groups, where a token has several groups
    listed = shared.select("token", "class", "n", "pos").join(groups, "class", "left").withColumn("group", F.coalesce("group", "class"))
    several = listed.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("token")
    listed = written(listed.join(several, "token"), "several")
    discard(shared)
    matrix = listed.groupBy("token", "group").agg(F.max(n - pos).alias("rest"), F.min("n").alias("least"), F.max("n").alias("most"))
    asks = listed.withColumnsRenamed({"class": "a", "n": "an", "pos": "ap", "group": "ag"})
    rest = F.least(F.col("an") - F.col("ap"), F.col("rest"))
    smallest = F.greatest("least", F.ceil(3 * F.col("an") / 4))  # of a member that can link at all
    opened = asks.join(matrix, "token").where((F.col("ag") < F.col("group")) & (7 * rest >= 3 * (F.col("an") + smallest)) & (4 * F.col("an") >= 3 * F.col("least")) & (3 * F.col("an") <= 4 * F.col("most")))
    members = listed.withColumnsRenamed({"class": "b", "n": "bn", "pos": "bp"})
    pairs = opened.select("token", "group", "a", "an", "ap").join(members, ["token", "group"]).where(_possible(F.col("an"), F.col("ap"), F.col("bn"), F.col("bp")))
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
    discard(listed)
    last = found
    if not pairs.isEmpty():
        more = _verified(pairs, docs, classes.select("class", "doc_id", "text_key"), k)
        last = written(connected_components(links.unionByName(more)), "groups")
        groups = last.select(F.col("id").alias("class"), F.col("component").alias("group"))
        discard(found, more)
    discard(links, stars, pairs)

    # hot groups and hot classes (a third of all rows may be one) are named where their rows are
    linked = groups.join(classes.select("class", "low"), "class")
    smallest = written(linked.groupBy("group").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members")), "smallest")
    hot = F.col("members") * HOT_PARTS > groups.count()
    linked = join_by_hot_keys(groups, smallest, "group", hot, "members").select("class", "component_id", F.col("group").alias("group_id"))
    alone = classes.join(groups, "class", "left_anti").select("class", F.col("low").alias("component_id"), F.col("class").alias("group_id"))
    named = written(linked.unionByName(alone).join(classes.select("class", "copies"), "class"), "named")
    discard(classes, smallest, last)
    hot = F.col("copies") * HOT_PARTS > rows.count()
    whole = join_by_hot_keys(rows.where("n > 0").select("doc_id", "n", "class", "text_key"), named, "class", hot, "copies")
    whole = whole.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_key", "group_id")
    return whole.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_key", F.lit(None).cast("long").alias("group_id")))


def keep_one_of_each_group(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """The rows of docs that stay: of each group the one with the smallest doc_id (null last, then text), and all without words.

    A row is told by doc_id and text; if such a row is repeated, the repetition whose columns have the lowest hash stays.
    """
    found = link_groups(docs, k)
    first = found.where("group_id is not null").groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("f")).select("f.doc_id", "f.text_key")
    stay = written(first.unionByName(found.where("group_id is null").select("doc_id", "text_key").distinct()), "stay")
    # names that docs does not have
    mark = "_" * (1 + max(len(c) for c in docs.columns))
    stay = stay.withColumnsRenamed({"doc_id": f"{mark}id", "text_key": f"{mark}key"})
    keyed = docs.withColumn(f"{mark}text", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{mark}id")) & (F.col(f"{mark}text") == F.col(f"{mark}key"))
    left = keyed.join(stay, mine, "left_semi")
    with_words = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    repeated = keyed.where(with_words).groupBy("doc_id", f"{mark}text").count().where("count > 1").limit(1)
    if not repeated.isEmpty():  # else nothing has to be dealt anew
        one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
        left = left.where(with_words).groupBy("doc_id", f"{mark}text").agg(one).select("row.*").unionByName(left.where(~with_words).select(*docs.columns))
    return left.select(*docs.columns)
