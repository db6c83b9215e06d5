"""Vectors that tasks compute from their rows, summed by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows that a task turns into a vector at once.
BATCH_ROWS = 4096


def summed(rows: DataFrame, size: int, shared: object, compute: Callable[[object, pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all rows of compute(shared, batch), a vector of this size for some rows.

    A task gives one vector, as a row a place, and Spark adds the places up: what is sent grows with the vector and the number of
    tasks, what comes to the driver with the vector alone. Sums are those of doubles, in any order.
    """
    value = rows.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for i in range(0, b.num_rows, BATCH_ROWS):
                mine = compute(value.value, b.slice(i, BATCH_ROWS))
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["place", "value"])

    found = rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[found["place"].to_numpy()] = found["value"].to_numpy()
    value.unpersist()
    return out
