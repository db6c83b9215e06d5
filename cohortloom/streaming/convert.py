"""Incremental conversion of a folder of CSV files to Parquet: files that came since the last run are read, once each."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F


def convert_new_files(spark: SparkSession, source: str, target: str, schema: str, state: str, as_text: list[str] | None = None) -> int:
    """Appends what is new and stops; returns the rows appended. `state` is the stream's checkpoint folder.

    A run that breaks off is repeated from its checkpoint; Parquet files become visible when a run has committed them.
    """
    rows = spark.readStream.option("header", True).schema(schema).csv(source)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in as_text or [] if c in rows.columns})
    run = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(p["numInputRows"] for p in run.recentProgress)
