"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .session import use_checkpoints

#: A key is hot if it has more than this part of all rows; so there are at most as many hot keys as parts, whatever the table.
HOT_PARTS = 1000


def join_by_hot_keys(rows: DataFrame, values: DataFrame, key: str, hot: Column, value: str) -> DataFrame:
    """rows with the columns of values, which has every key once; the hot keys' values are broadcast, so their rows stay where they are.

    hot: which rows of values have a hot key, HOT_PARTS of them at most; value: a column of values that is never null.
    Null keys match nothing.
    """
    few = rows.join(F.broadcast(values.where(hot)), key, "left")
    rest = few.where(F.col(value).isNull()).select(*rows.columns).join(values.where(~hot), key)
    return few.where(F.col(value).isNotNull()).unionByName(rest)


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id in links (a, b) can reach.

    A round is two grouped minima, each over one shuffle, and a distinct; it is written to the checkpoint folder, so lost
    executors cost no earlier round. Null ends and links to oneself are ignored.
    """
    use_checkpoints(links.sparkSession)
    # each link once, from the larger id to the smaller one
    stars = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), (F.col("a") != F.col("b")).alias("ok")).where("ok").select("u", "v").distinct().checkpoint()
    lowest = F.min("v").over(Window.partitionBy("u"))
    before = None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        # large star: all larger neighbours of u, to the smallest of u and its neighbours
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least(lowest, F.col("u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours, to the smallest of them
        small = large.withColumn("m", lowest)
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
        stars = small.select(F.explode(ends).alias("e")).select("e.*").where("u != v").distinct().checkpoint()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
