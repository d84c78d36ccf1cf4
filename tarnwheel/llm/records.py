"""Token ids in length-delimited binary files, with an offset index beside each.

A file is a run of records, each

    length of the payload   unsigned 64-bit
    masked checksum of the eight length bytes   unsigned 32-bit
    payload
    masked checksum of the payload   unsigned 32-bit

all little-endian; the checksum is CRC-32 (zlib's), masked by a rotation of 15 bits and a fixed sum, so that a
checksum over data that holds checksums stays useful. The payload is one flag byte (1: the id is null), the 64-bit id,
one byte for the width of a token id (2 or 4), then the token ids. `part-N.idx` holds the 64-bit offset of each record
of `part-N.rec`, so a reader can take records in any order. Files are numbered in ascending order of id, nulls first.

Writing is one task a file: to a name of its own, then renamed, so a task that runs again leaves the same file.

Defined results: a null or empty text is the end id alone; rows with equal ids follow each other in the order of a
hash of their text, equal rows in any; an empty table writes no files and gives no rows; other columns don't matter.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.llm.pretokens import encoder
from tarnwheel.llm.textarrays import released
from tarnwheel.session import scratch, written

END_ID = 0
_MASK = 0xA282EAD8
_HEAD = np.dtype([("null", "u1"), ("id", "<i8"), ("width", "u1")])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return b"".join((size, masked(size).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")))


def payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return np.array((doc_id is None, doc_id or 0, width), _HEAD).tobytes() + ids.astype(f"<u{width}").tobytes()


def parsed(data: bytes) -> tuple[int | None, np.ndarray]:
    head = np.frombuffer(data, _HEAD, 1)[0]
    return None if head["null"] else int(head["id"]), np.frombuffer(data, f"<u{head['width']}", offset=_HEAD.itemsize).astype("<u4")


class Store:
    """Files by URI: local paths directly, other schemes through pyarrow's file systems."""

    def __init__(self, uri: str):
        scheme, colon, rest = uri.partition(":")
        self.local = not colon or scheme == "file"
        if self.local:
            self.path = "/" + rest.lstrip("/") if colon else uri
        else:
            from pyarrow import fs

            self.fs, self.path = fs.FileSystem.from_uri(uri)

    def create(self, name: str):
        if self.local:
            os.makedirs(self.path, exist_ok=True)
            return open(f"{self.path}/{name}", "wb")
        self.fs.create_dir(self.path, recursive=True)
        return self.fs.open_output_stream(f"{self.path}/{name}")

    def move(self, name: str, to: str) -> None:
        if self.local:
            os.replace(f"{self.path}/{name}", f"{self.path}/{to}")
        else:
            self.fs.move(f"{self.path}/{name}", f"{self.path}/{to}")

    def open(self, name: str):
        return open(f"{self.path}/{name}", "rb") if self.local else self.fs.open_input_file(f"{self.path}/{name}")


def _one(stream, name: str) -> bytes | None:
    """The next record's payload, None at the end; both checksums are compared."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != int.from_bytes(head[8:], "little"):
        raise ValueError(f"{name}: a record's length is damaged")
    size = int.from_bytes(head[:8], "little")
    data, tail = stream.read(size), stream.read(4)
    if len(data) < size or masked(data) != int.from_bytes(tail, "little"):
        raise ValueError(f"{name}: a record's payload is damaged")
    return data


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encodes and writes all texts in ascending id; gives the manifest, a row for each file: part, records, ids."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, store = TaskContext.get(), Store(folder)
        part, own = context.partitionId(), f"{context.taskAttemptId()}-{uuid.uuid4().hex}"
        records, total, at, out, index = 0, 0, 0, None, None
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, b, ids, begin in encoder(tokenizer).column(batch.column(1)):
                out = out or store.create(f".rec-{own}")
                index = index or store.create(f".idx-{own}")
                for r in range(a, b):
                    data = frame(payload(doc_ids[r], np.append(ids[begin[r - a] : begin[r - a + 1]], end_id)))
                    out.write(data)
                    index.write(at.to_bytes(8, "little"))
                    at, records, total = at + len(data), records + 1, total + int(begin[r - a + 1] - begin[r - a]) + 1
        if out:
            for stream, kind in ((out, "rec"), (index, "idx")):
                stream.close()
                store.move(f".{kind}-{own}", f"part-{part:06d}.{kind}")
            yield pa.RecordBatch.from_pydict({"part": [part], "records": [records], "ids": [total]})
        released("encoder")

    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumns({"_h": F.xxhash64("text"), "_from": F.spark_partition_id()})
    order = (F.col("id").asc_nulls_first(), "_h", "_from")
    files = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text").mapInArrow(run, "part long, records long, ids long")
    return written(files, "records-manifest")


def read(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Reads the files back: a row for each record with its id, start, n_tokens and the checksum of its ids."""
    files = sorted((r["part"], r["ids"]) for r in manifest.collect())  # a row for each written file
    starts = np.concatenate([[0], np.cumsum([n for _, n in files])]).tolist()
    rows = [(part, start) for (part, _), start in zip(files, starts, strict=False)]
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(folder)
        for batch in batches:
            for part, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                name, out = f"part-{part:06d}.rec", []
                with store.open(name) as stream:
                    while (data := _one(stream, name)) is not None:
                        doc_id, ids = parsed(data)
                        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(out) == 10_000:
                            yield _rows(out, id_col)
                            out = []
                yield _rows(out, id_col)
        released("encoder")

    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long"
    return spark.createDataFrame(rows, "part long, start long").repartition(max(1, len(rows))).mapInArrow(run, schema)


def _rows(out: list[tuple], id_col: str) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [id_col, "start", "n_tokens", "ids_crc32"])


def fetch(folder: str, part: int, positions: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Single records of one file in the order asked for, by the offset index."""
    store, name = Store(folder), f"part-{part:06d}.rec"
    with store.open(f"part-{part:06d}.idx") as stream:
        offsets = np.frombuffer(stream.read(), "<u8")
    with store.open(name) as stream:
        out = []
        for p in positions:
            stream.seek(int(offsets[p]))
            out.append(parsed(_one(stream, name)))
    return out


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the files to a new shared folder and reads them back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch(docs.sparkSession, "records")
    return read(write(docs, folder, tokenizer), folder)


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
