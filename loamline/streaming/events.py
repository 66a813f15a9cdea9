"""Event-time queries over streams, and sinks that count every row once."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_of(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A stream of the parquet files below a folder, with their event time as a timestamp."""
    schema = spark.read.parquet(path).schema
    folder, glob = (path, "*.parquet") if os.path.isdir(path.removeprefix("file://")) else os.path.split(path)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", glob).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums by event type in tumbling or sliding windows."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    made = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return made.select(F.col("w.start").alias("start"), "event_type", "n", F.round("value", 4).alias("value"))


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """A user's events with less than ``gap`` between them."""
    made = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return made.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; its state is dropped when the watermark has passed it."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def run_to_end(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and gives what it wrote.

    Append mode writes a window when the watermark has passed it, so the windows that are still open stay
    in the state; complete mode writes all of them, in one batch that replaces the one before.
    """
    spark = stream.sparkSession
    out, state = f"{path}/rows", f"{path}/state"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:
        query = writer.foreachBatch(replace_batch(out)).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def replace_batch(path: str):
    """A sink for results that are whole in every batch."""

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(path)

    return write


def once_per_batch(path: str):
    """A sink that writes each batch into a folder of its number, so that a batch that is run again replaces itself."""

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return write
