"""A connector over folders of Parquet files: batch and stream reads with offsets, and writes that a manifest commits.

Reading. A stream's offset is the name of the last file it has taken; a batch takes all files whose names come after, one
part for each row group, so names have to ascend with time (as those of this writer do). Offsets are in the query's
checkpoint, so a stream that starts anew goes on behind them.

Writing. Each task writes files of hidden names and tells them in its commit message; the driver then writes the batch's
manifest, and only what a manifest lists is read, in the order of batches. A batch that runs again replaces its manifest,
an aborted one deletes its files, so each batch is there once or not at all.

Paths are those of the box, or URIs that pyarrow knows (file, hdfs, s3); Python does the reading, so a store that only
Spark's own readers can open needs those. An empty folder has no rows; files keep the columns that the schema asks for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "_batch-"
#: Rows that a written file holds at most, and a task in memory.
ROWS = 100_000


def _folder(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _listed(path: str) -> dict[str, str]:
    """The folder's data files by what orders them: batch and name where manifests list them, else the name alone."""
    from pyarrow import fs

    system, at = _folder(path)
    if system.get_file_info(at).type == fs.FileType.File:
        return {"": ""}
    found = [f for f in system.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.is_file]
    manifests = [f for f in found if f.base_name.startswith(MANIFEST)]
    if not manifests:
        return {f.base_name: f.base_name for f in sorted(found, key=lambda f: f.base_name) if f.base_name[0] not in "_."}
    names: dict[str, str] = {}
    for m in sorted(manifests, key=lambda f: f.base_name):
        with system.open_input_stream(m.path) as stream:
            names |= {f"{m.base_name.removeprefix(MANIFEST)}/{n}": n for n in sorted(json.loads(stream.read()))}
    return names


@dataclass
class RowGroup(InputPartition):
    name: str
    group: int


class _Reads:
    """What batch and stream reads have in common."""

    def __init__(self, schema: StructType, options: dict):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.schema = options["path"], to_arrow_schema(schema)

    def groups(self, names: list[str]) -> list[RowGroup]:
        import pyarrow.parquet as pq

        system, at = _folder(self.path)
        return [RowGroup(n, g) for n in names for g in range(pq.ParquetFile(f"{at}/{n}" if n else at, filesystem=system).num_row_groups)]

    def read(self, partition: RowGroup | None) -> Iterator:
        if partition is None:  # Spark's part of an empty read
            return
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, at = _folder(self.path)
        with pq.ParquetFile(f"{at}/{partition.name}" if partition.name else at, filesystem=system) as file:
            for batch in file.iter_batches(row_groups=[partition.group], columns=self.schema.names, batch_size=10_000):
                yield from pa.Table.from_batches([batch]).select(self.schema.names).cast(self.schema).to_batches()


class FilesReader(_Reads, DataSourceReader):
    def partitions(self) -> list[RowGroup]:
        return self.groups([*_listed(self.path).values()])


class FilesStreamReader(_Reads, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"last": None}

    def latestOffset(self) -> dict:
        return {"last": max(_listed(self.path), default=None)}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        after = lambda k: start["last"] is None or k > start["last"]
        return [] if end["last"] is None else self.groups([n for k, n in _listed(self.path).items() if after(k) and k <= end["last"]])

    def commit(self, end: dict) -> None:
        """The checkpoint has the offset; there is nothing to give back."""


@dataclass
class Wrote(WriterCommitMessage):
    names: list[str]


class _Writes:
    def __init__(self, schema: StructType, options: dict):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.schema = options["path"], to_arrow_schema(schema)

    def write(self, iterator: Iterator) -> Wrote:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        system, at = _folder(self.path)
        system.create_dir(at, recursive=True)
        names, held = [], []

        def put() -> None:
            import pyarrow as pa

            name = f".{TaskContext.get().partitionId():06d}-{len(names):06d}-{uuid.uuid4().hex}.parquet"
            pq.write_table(pa.Table.from_batches(held).cast(self.schema), f"{at}/{name}", filesystem=system)
            names.append(name)
            held.clear()

        for batch in iterator:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS:
                put()
        if held:
            put()
        return Wrote(names)

    def publish(self, messages: list[Wrote | None], batch: str) -> None:
        system, at = _folder(self.path)
        system.create_dir(at, recursive=True)
        names = [n for m in messages if m for n in m.names]
        with system.open_output_stream(f"{at}/.{MANIFEST}{batch}") as stream:
            stream.write(json.dumps(names).encode())
        system.move(f"{at}/.{MANIFEST}{batch}", f"{at}/{MANIFEST}{batch}")

    def discard(self, messages: list[Wrote | None]) -> None:
        system, at = _folder(self.path)
        for m in messages:
            for n in m.names if m else []:
                system.delete_file(f"{at}/{n}")


class FilesWriter(_Writes, DataSourceArrowWriter):
    def commit(self, messages: list[Wrote | None]) -> None:
        self.publish(messages, f"b{uuid.uuid4().hex}")

    def abort(self, messages: list[Wrote | None]) -> None:
        self.discard(messages)


class FilesStreamWriter(_Writes, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Wrote | None], batchId: int) -> None:
        self.publish(messages, f"{batchId:012d}")

    def abort(self, messages: list[Wrote | None], batchId: int) -> None:
        self.discard(messages)


class Files(DataSource):
    """Option path; the schema has to be given for reads."""

    @classmethod
    def name(cls) -> str:
        return "tarnwheel_files"

    def schema(self) -> str:
        raise ValueError("tarnwheel_files needs a schema")

    def reader(self, schema: StructType) -> FilesReader:
        return FilesReader(schema, self.options)

    def streamReader(self, schema: StructType) -> FilesStreamReader:
        return FilesStreamReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(schema, self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> FilesStreamWriter:
        return FilesStreamWriter(schema, self.options)


def register(spark: SparkSession) -> str:
    """Makes the connector known to the session; its name."""
    spark.dataSource.register(Files)
    return Files.name()
