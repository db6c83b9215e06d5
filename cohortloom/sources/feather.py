"""A Spark data source for Feather files: a partition for each record batch.

The driver reads a file's schema and the number of its record batches; each task opens the file and reads its own batches. Paths are
those that pyarrow's file systems know (local and shared folders, hdfs, s3, ...), and executors have to reach them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

#: Rows that a task hands to Spark at once.
BATCH_ROWS = 65_536


def _files(path: str) -> tuple[pa.fs.FileSystem, list[str]]:
    """The file system, and the path or the Feather files of a folder."""
    from pyarrow import fs

    system, where = fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)
    if system.get_file_info(where).type != fs.FileType.Directory:
        return system, [where]
    return system, sorted(f.path for f in system.get_file_info(fs.FileSelector(where, recursive=True)) if f.path.endswith(".feather"))


@dataclass
class Batches(InputPartition):
    """Some record batches of a file; all of it, if the file is of the first version, which has no batches."""

    file: str
    batch: int | None


class FeatherReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def partitions(self) -> list[Batches]:
        system, files = _files(self.path)
        out: list[Batches] = []
        for name in files:
            with system.open_input_file(name) as f:
                out += [Batches(name, i) for i in range(pa.ipc.open_file(f).num_record_batches)] if _is_ipc(system, name) else [Batches(name, None)]
        return out or [Batches("", None)]

    def read(self, partition: Batches) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        from pyarrow import feather

        system, _ = _files(self.path)
        with system.open_input_file(partition.file) as f:
            if partition.batch is None:
                found = feather.read_table(f).to_batches()
            else:
                found = [pa.ipc.open_file(f).get_batch(partition.batch)]
            for b in found:
                plain = pa.Table.from_batches([b]).select(self.schema.names)
                for i, c in enumerate(plain.columns):
                    if pa.types.is_dictionary(c.type):
                        plain = plain.set_column(i, plain.field(i).name, c.cast(c.type.value_type))
                yield from plain.to_batches(max_chunksize=BATCH_ROWS)


def _is_ipc(system, name: str) -> bool:
    with system.open_input_file(name) as f:
        return f.read(6) == b"ARROW1"


class FeatherSource(DataSource):
    """spark.read.format("feather").load(path): a file, or a folder of files of one schema."""

    @classmethod
    def name(cls) -> str:
        return "feather"

    def schema(self) -> StructType:
        from pyarrow import feather

        system, files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no Feather file at {self.options['path']}")
        with system.open_input_file(files[0]) as f:
            found = pa.ipc.open_file(f).schema if _is_ipc(system, files[0]) else feather.read_table(f).schema
        fields = [pa.field(x.name, x.type.value_type if pa.types.is_dictionary(x.type) else x.type) for x in found]
        return from_arrow_schema(pa.schema(fields), prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> FeatherReader:
        return FeatherReader(self.options["path"], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(FeatherSource)
    return spark.read.format("feather").load(path)
