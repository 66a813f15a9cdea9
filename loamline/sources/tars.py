"""Samples in tar archives, and the index of an archive's members."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.sources.blobs import write_blobs


def write_tars(samples: DataFrame, path: str, split: str) -> list[tuple[str, int]]:
    """One archive for each partition of (key, extension, content); samples without content are skipped."""

    def pack(number: int, rows: Iterator[dict]) -> Iterator[tuple[str, bytes]]:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as tar:
            for r in rows:
                if r["content"] is not None:
                    info = tarfile.TarInfo(f"{r['key']}.{r['extension']}")
                    info.size = len(r["content"])
                    tar.addfile(info, io.BytesIO(bytes(r["content"])))
        yield f"{split}-shard-{number:06d}.tar", out.getvalue()

    return write_blobs(samples.select("key", "extension", "content"), path, pack)


def read_tars(spark: SparkSession, path: str) -> DataFrame:
    """(archive, key, extension, offset, content) of the members of the archives below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("archive", pa.string()), ("key", pa.string()), ("extension", pa.string()), ("offset", pa.int64()), ("content", pa.binary())])
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    rows = []
                    for m in tar:
                        key, _, extension = m.name.partition(".")
                        rows.append({"archive": archive.rsplit("/", 1)[-1], "key": key, "extension": extension, "offset": m.offset, "content": tar.extractfile(m).read()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(path)
    return listed.select("path", "content").mapInArrow(run, "archive string, key string, extension string, offset bigint, content binary")


def member_index(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(archive, key, sample, offset, bytes): where each sample starts and how far it reaches, up to the next one.

    ``sizes`` has (archive, bytes); the last sample ends at the end of the archive's blocks of 512.
    """
    starts = members.groupBy("archive", "key").agg(F.min("offset").alias("offset")).join(sizes.withColumnRenamed("bytes", "end"), "archive")
    order = Window.partitionBy("archive").orderBy("offset")
    upto = F.coalesce(F.lead("offset").over(order), F.ceil(F.col("end") / 512) * 512)
    return starts.select("archive", "key", (F.row_number().over(order) - 1).alias("sample"), "offset", (upto - F.col("offset")).alias("bytes"))
