"""Indexed datasets: a file of tokens and an index beside it, as a Python data source (``binidx``).

    df.write.format("binidx").option("dtype", "int32").mode("append").save(folder)
    spark.read.format("binidx").load(folder)

Each partition streams its own pair of files; the driver commits by renaming them, so a task that is run
again leaves nothing behind.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from loamline.sources.blobs import mounted

# The layout of an index.
MAGIC = b"MMIDIDX\x00\x00"
VERSION = 1
CODES = {"int32": 4, "int64": 5, "uint16": 8}


def write_index(path: str, dtype: str, lengths: list[int]) -> None:
    sizes = np.array(lengths, np.int32)
    starts = np.zeros(len(sizes), np.int64)
    np.cumsum(sizes[:-1].astype(np.int64) * np.dtype(dtype).itemsize, out=starts[1:])
    with open(path, "wb") as f:
        f.write(MAGIC + struct.pack("<QBQQ", VERSION, CODES[dtype], len(sizes), len(sizes) + 1))
        f.write(sizes.tobytes() + starts.tobytes() + np.arange(len(sizes) + 1, dtype=np.int64).tobytes())


def read_index(path: str) -> tuple[str, np.ndarray, np.ndarray]:
    """(dtype, lengths, byte offsets) of an index."""
    with open(path, "rb") as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no index")
        version, code, n, _ = struct.unpack("<QBQQ", f.read(25))
        if version != VERSION or code not in CODES.values():
            raise ValueError(f"{path} has an unknown version or type")
        return next(k for k, v in CODES.items() if v == code), np.frombuffer(f.read(4 * n), np.int32), np.frombuffer(f.read(8 * n), np.int64)


@dataclass
class _Commit(WriterCommitMessage):
    attempt: str
    final: str
    sequences: int
    tokens: int


@dataclass
class _Part(InputPartition):
    stem: str
    first: int
    last: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.folder, self.dtype, self.overwrite = mounted(options["path"]), options.get("dtype", "int32"), overwrite
        if self.dtype not in CODES:
            raise ValueError(f"tokens can't be written as {self.dtype}")
        self.column = schema.fieldNames().index(options.get("column", schema.fieldNames()[-1]))
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        os.makedirs(self.folder, exist_ok=True)
        number = TaskContext.get().partitionId()
        attempt = os.path.join(self.folder, f".{uuid.uuid4().hex}")
        lengths, limits = [], np.iinfo(self.dtype)
        with open(attempt + ".bin", "wb") as f:
            for batch in batches:
                column = batch.column(self.column)
                wide = pc.cast(column.flatten(), pa.int64()).to_numpy()
                if len(wide) and (wide.min() < limits.min or wide.max() > limits.max):
                    raise ValueError(f"a token doesn't fit {self.dtype}")
                f.write(wide.astype(self.dtype).tobytes())
                lengths += pc.fill_null(pc.list_value_length(column), 0).to_pylist()
        write_index(attempt + ".idx", self.dtype, lengths)
        return _Commit(attempt, os.path.join(self.folder, f"part-{self.job[:8]}-{number:05d}"), len(lengths), sum(lengths))

    def commit(self, messages: list) -> None:
        if self.overwrite:
            for name in os.listdir(self.folder):
                if name.startswith("part-"):
                    os.remove(os.path.join(self.folder, name))
        for m in messages:
            if m is not None:
                for end in (".bin", ".idx"):
                    os.replace(m.attempt + end, m.final + end)

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None:
                for end in (".bin", ".idx"):
                    if os.path.exists(m.attempt + end):
                        os.remove(m.attempt + end)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.rows = mounted(options["path"]), int(options.get("rowsPerPartition", 100_000))
        self.batch = 2_000

    def partitions(self) -> list[InputPartition]:
        parts = []
        for name in sorted(os.listdir(self.folder)):
            if name.endswith(".idx") and not name.startswith("."):
                stem = os.path.join(self.folder, name[:-4])
                n = len(read_index(stem + ".idx")[1])
                parts += [_Part(stem, k, min(n, k + self.rows)) for k in range(0, n, self.rows)]
        return parts

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        dtype, lengths, starts = read_index(partition.stem + ".idx")
        name = os.path.basename(partition.stem)
        with open(partition.stem + ".bin", "rb") as f:
            for k in range(partition.first, partition.last, self.batch):
                own = lengths[k : min(k + self.batch, partition.last)]
                f.seek(int(starts[k]))
                flat = np.frombuffer(f.read(int(own.sum(dtype=np.int64)) * np.dtype(dtype).itemsize), dtype).astype(np.int64)
                offsets = np.r_[0, np.cumsum(own, dtype=np.int64)].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own)), pa.array(np.arange(k, k + len(own))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["file", "seq_id", "tokens"])


class BinIdx(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binidx"

    def schema(self) -> str:
        return "file string, seq_id bigint, tokens array<bigint>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(BinIdx)
