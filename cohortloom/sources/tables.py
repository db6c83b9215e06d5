"""Readers and sinks: Parquet, CSV (also gzip), Feather, catalogue tables, JSON reports.

Every reader gives a lazy DataFrame whose floating-point columns have NULL instead of NaN, so that
"missing" means one thing downstream.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Extensions by reader, longest first.
FORMATS = {".csv.gz": "csv", ".parquet": "parquet", ".feather": "feather", ".csv": "csv"}


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("float", "double")}
    return df.withColumns(floats) if floats else df


def file_format(path: str) -> str:
    for ending, kind in FORMATS.items():
        if path.lower().rstrip("/").endswith(ending):
            return kind
    raise ValueError(f"no reader for {path}; known: {sorted(FORMATS)}")


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Reads a file or folder by its extension. CSV without a schema is inferred, which reads it twice."""
    kind = file_format(path)
    if kind == "parquet":
        return nan_to_null(spark.read.parquet(path))
    if kind == "csv":
        reader = spark.read.option("header", True)
        rows = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
        # a gzip file is one task to read, so its rows are dealt out for what follows
        return nan_to_null(rows.repartition(spark.sparkContext.defaultParallelism) if path.lower().endswith(".gz") else rows)
    return nan_to_null(read_feather(spark, path))


def read_feather(spark: SparkSession, path: str) -> DataFrame:
    """A file or a folder of files, a task for each record batch."""
    from cohortloom.sources import feather

    return feather.read(spark, path)


def existing(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that there are, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalogue table, projected to those of the columns that exist (the scan reads no others)."""
    df = spark.table(name)
    return nan_to_null(df.select(*existing(df, columns)) if columns else df)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def to_parquet(spark: SparkSession, source: str, target: str, as_text: list[str] | None = None) -> None:
    """Converts any readable file; columns in as_text become strings."""
    df = read(spark, source)
    write_parquet(df.withColumns({c: F.col(c).cast("string") for c in existing(df, as_text or [])}), target)


def convert_large(spark: SparkSession, sources: dict[str, str], folder: str, least_mb: float = 500, home: str | None = None) -> dict[str, str]:
    """Converts CSV files of more than least_mb; returns original -> converted and writes the same map as JSON. home: the path that the folder will have."""
    done = {}
    for name, path in sources.items():
        if file_format(path) == "csv" and size_mb(spark, path) > least_mb:
            to_parquet(spark, path, f"{folder}/{name}.parquet")
            done[path] = f"{home or folder}/{name}.parquet"
    write_json(spark, done, f"{folder}/conversion_map.json")
    return done


def converted(spark: SparkSession, path: str, folder: str | None) -> str:
    """The Parquet that convert_large() made of a source into the folder, or the source itself."""
    where = f"{folder}/conversion_map.json"
    if not folder or not path_exists(spark, where):
        return path
    return json.loads("".join(r["value"] for r in spark.read.text(where, wholetext=True).collect())).get(path, path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def create_table_as(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A catalogue table of what a SQL query gives, in place of an earlier one."""
    write_table(spark.sql(query), name)
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def size_mb(spark: SparkSession, path: str) -> float:
    """By the file system that Spark reads the path from."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength() / 1e6


def write_json(spark: SparkSession, value: object, path: str) -> None:
    """A small report, written by the file system that Spark writes the path to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(json.dumps(value, indent=1, sort_keys=True, default=str).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> object:
    return json.loads("".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def rename(spark: SparkSession, source: str, target: str) -> None:
    """One step of the file system; an earlier target goes first."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir); without one, only where Spark runs on this machine, a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="scratch")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stage_path(folder: str, name: str, settings: object) -> str:
    """Where a stage's result lies; other settings give another path, so a result is never taken for another's."""
    mark = hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()[:12]
    return f"{folder}/{Path(name).name}_{mark}.parquet"
