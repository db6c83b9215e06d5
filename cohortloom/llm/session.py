"""The shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .arrowtext import give_back


#: Bytes at which a batch that goes to Python ends.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches that go to Python end at BATCH_BYTES (a longer row goes alone), unless the session has set a bound of its own.

    Both sides hold a batch, and the usual bound is a number of rows, whatever their length.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def use_checkpoints(spark: SparkSession) -> None:
    """Takes the cluster's spark.checkpoint.dir; only where it is unset, and Spark runs on this machine alone, an own folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoints")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    use_checkpoints(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet to the shared checkpoint folder and read again: lineage ends there."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    again = frame.sparkSession.read.schema(frame.schema).parquet(path)
    again._written_to = path
    return again


def discard(*frames: DataFrame) -> None:
    """Deletes what written() wrote for these frames; all that reads them must have been written itself.

    What was collected from them has mostly served by then, so the driver gives freed memory back as well.
    """
    for frame in frames:
        remove(frame.sparkSession, frame._written_to)
    give_back()


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
