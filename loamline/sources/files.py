"""Files: what there is, how it is read and how it is cut into blocks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline.functions.text import format_of


def discover(spark: SparkSession, path: str, known: tuple[str, ...] = ("json", "parquet", "csv")) -> DataFrame:
    """(path, name, format, size, modified) of the files of known formats below ``path``. No content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = listed.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return named.withColumn("format", format_of(F.col("name"))).where(F.col("format").isin(*known))


def one_format(listed: DataFrame) -> str:
    """The format of all files; files of several formats, or of none, are an error."""
    found = [r["format"] for r in listed.select("format").distinct().limit(10).collect()]
    if len(found) != 1:
        raise ValueError(f"files of one known format are needed; there are {sorted(found) or 'none'}")
    return found[0]


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, drop_broken: bool = False) -> DataFrame:
    """JSON lines by a given schema, blank lines left out. Broken lines are an error unless they are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if drop_broken else "FAILFAST").json(path)


def blocks(listed: DataFrame, part: str, name: str, size: str, budget: int) -> DataFrame:
    """A block number for each file of a part, so that a block starts whenever the files before it fill a budget."""
    upto = Window.partitionBy(part).orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    return listed.withColumn("block", F.floor((F.sum(size).over(upto) - F.col(size)) / budget))


def read_zips(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, content): the files inside the zip archives below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in z.namelist():
                        if not member.endswith("/"):
                            yield pa.RecordBatch.from_pylist([{"archive": archive, "member": member, "content": z.read(member)}])

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", "content").mapInArrow(run, "archive string, member string, content binary")


def read_any(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The table of the files below ``path``, which must be of one known format."""
    found = one_format(discover(spark, path))
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("header", "true").csv(path) if found == "csv" else reader.load(path, format=found)


def write_zips(members: DataFrame, path: str, name: str, content: str) -> list[tuple[str, int]]:
    """One zip archive for each partition of (name, content)."""
    from loamline.sources.blobs import write_blobs

    def pack(number: int, rows: Iterator[dict]) -> Iterator[tuple[str, bytes]]:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for r in rows:
                if r[content] is not None:
                    z.writestr(r[name], r[content])
        yield f"part-{number:05d}.zip", out.getvalue()

    return write_blobs(members.select(name, content), path, pack)
