"""Proportional stratified interleaving into shards (operator 5), in DataFrame functions only.

Rows are put in a seeded order within their source (a hash of doc_id, text and seed), each gets its fractional
rank (rank + start) / rows of the source, and the rows sorted by fractional rank are cut into shards
whose row counts differ by one at most. The start is a seeded hash of the source between 0 and 1, so sources of few rows
spread over all shards. Every prefix of that order has each source in proportion, so every shard has the mixture of the whole.

No window sees more than a small piece: ranks are counted within (source, bucket of the seeded hash)
and offset by the sums of the earlier buckets, and places are counted in the same way within buckets of
the fractional rank. Equal rows are counted as one with a weight and dealt out again at the end, PIECE copies from one row, so a
row that is repeated for a third of the table is no hot key either.

Defined results: a null source is a source of its own; a null text has size 1 and crc32 0; a null doc_id stays null; a very
long text counts as one row; equal texts (the groups) are rows like any other, dealt apart; repeated rows keep a slot each;
ties of fractional ranks go by source and rank; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Buckets that ranks and places are counted in; the sums over buckets are this small at any input size.
BUCKETS = 4096
#: Most copies of a row that are dealt out from one row; a row with more is cut into as many first, and these are spread.
PIECE = 4096
#: Different starts of a source.
STARTS = 1 << 16


def _rank_sums(counts: DataFrame, by: list[str], bucket: str, n: str) -> DataFrame:
    """before: how many rows lie in the earlier buckets of the same `by`; of_all: rows of `by`."""
    w = Window.partitionBy(*by)
    return counts.withColumn("before", F.sum(n).over(w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))).withColumn("of_all", F.sum(n).over(w)).withColumn("before", F.coalesce("before", F.lit(0)))


def interleave(docs: DataFrame, n_shards: int = 8, seed: int = 17) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text: Column = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("stratum"), F.col("source").cast("string"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    same = ["doc_id", "stratum", "source", "size", "text_crc32"]
    rows = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")).withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(BUCKETS)).cast("int"))

    def offset(frame: DataFrame, by: list[str], bucket: str, order: list[str]) -> DataFrame:
        """rank0: copies before this row, in the order of bucket and `order`, within `by`."""
        sums = _rank_sums(frame.groupBy(*by, bucket).agg(F.sum("copies").alias("n")), by, bucket, "n").drop("n")
        inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        frame = frame.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        return frame.join(sums, [*by, bucket]).withColumn("rank0", F.col("before") + F.col("inside")).drop("before", "inside")

    ranked = offset(rows, ["stratum"], "bucket", ["h", "doc_id", "size", "text_crc32"])
    ranked = ranked.select(*same, "h", F.col("of_all").alias("of_source"), "rank0", "copies")
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(PIECE).cast("long"))
    many = ranked.where(F.col("copies") > PIECE).withColumn("piece", F.explode(starts)).repartition("h", "piece")
    many = many.withColumn("rank0", F.col("rank0") + F.col("piece")).withColumn("copies", F.least(F.lit(PIECE), F.col("copies") - F.col("piece"))).drop("piece")
    ranked = ranked.where(F.col("copies") <= PIECE).unionByName(many)
    ranked = ranked.withColumn("rank", F.explode(F.sequence(F.col("rank0"), F.col("rank0") + F.col("copies") - 1))).drop("rank0", "copies")
    start = F.pmod(F.xxhash64(F.lit(seed), "stratum"), F.lit(STARTS))
    spread = ranked.withColumn("place", (STARTS * F.col("rank") + start) / (STARTS * F.col("of_source"))).withColumn("part", F.floor(F.col("place") * BUCKETS).cast("int")).withColumn("all", F.lit(1)).withColumn("copies", F.lit(1))
    placed = offset(spread, ["all"], "part", ["place", "stratum", "rank"])
    # shard s holds the rows i with floor(s n / n_shards) <= i < floor((s + 1) n / n_shards)
    first = F.expr(f"(shard * of_all) div {n_shards}")
    return placed.withColumn("shard", F.expr(f"cast(((rank0 + 1) * {n_shards} - 1) div of_all as int)")).select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank0") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
