"""Files of any format from the rows of a table, one or more for each partition."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame


def mounted(path: str) -> str:
    """The path of a folder that is mounted on all machines; other file systems aren't written to by these formats."""
    folder = path.removeprefix("file://").removeprefix("file:")
    if "://" in folder:
        raise ValueError(f"{path} is not in a mounted file system")
    return folder


def write_blobs(rows: DataFrame, path: str, pack: Callable[[int, Iterator[dict]], Iterator[tuple[str, bytes]]]) -> list[tuple[str, int]]:
    """Writes what ``pack(partition, rows)`` gives as files in a folder that all executors see.

    Each file is written under a name of its attempt and then renamed, so that a task that is run
    again, or twice at once, leaves whole files only. Gives (name, bytes) of the files, which are as
    many as there are partitions.
    """
    folder = mounted(path)
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        os.makedirs(folder, exist_ok=True)
        for name, content in pack(number, (r for b in batches for r in b.to_pylist())):
            attempt = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
            with open(attempt, "wb") as f:
                f.write(content)
            os.replace(attempt, os.path.join(folder, name))
            yield pa.RecordBatch.from_pylist([{"name": name, "bytes": len(content)}], schema=pa.schema([("name", pa.string()), ("bytes", pa.int64())]))

    return sorted((r["name"], r["bytes"]) for r in rows.mapInArrow(run, "name string, bytes bigint").collect())
