"""Receipts of runs: which shard of which plan is done, as a small table that only grows.

A receipt is a row (plan, shard, status, stats, at); the latest one of a shard counts. Spark's commit protocol
makes outputs whole; receipts make runs that can go on where an earlier one ended.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "plan string, shard string, status string, stats string, at timestamp"


class Receipts:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _write(self, plan: str, shard: str, status: str, stats: str | None) -> None:
        row = [(plan, shard, status, stats, datetime.now(timezone.utc))]
        self.spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").json(self.folder)

    def started(self, plan: str, shard: str) -> None:
        self._write(plan, shard, "started", None)

    def completed(self, plan: str, shard: str, stats: str = "{}") -> None:
        self._write(plan, shard, "completed", stats)

    def failed(self, plan: str, shard: str, error: str) -> None:
        self._write(plan, shard, "failed", error[:2000])

    def table(self) -> DataFrame:
        """The latest receipt of each shard of each plan."""
        local = self.folder.removeprefix("file://").removeprefix("file:")
        if "://" not in self.folder and not os.path.isdir(local):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).json(self.folder)
        last = Window.partitionBy("plan", "shard").orderBy(F.desc("at"))
        return rows.withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")

    def done(self, plan: str, shard: str) -> bool:
        return not self.table().where((F.col("plan") == plan) & (F.col("shard") == shard) & (F.col("status") == "completed")).isEmpty()

    def once(self, plan: str, shard: str, work) -> bool:
        """Runs ``work`` unless the shard is done; its result, a text, is kept as statistics. False if it was done before."""
        if self.done(plan, shard):
            return False
        self.started(plan, shard)
        try:
            stats = work()
        except Exception as e:
            self.failed(plan, shard, str(e))
            raise
        self.completed(plan, shard, stats or "{}")
        return True
