"""Folders for what a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: under ``spark.checkpoint.dir``, or of this machine in a local session."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="loamline-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
