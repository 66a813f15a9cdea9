"""Session set-up and the one way in which lineage is cut."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and single-machine runs. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loamline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, so that its lineage ends there.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own; a cluster without it is an error, since a folder of one
    machine would be lost with that machine.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if shared is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="loamline-checkpoint-")
        sc.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work in Python that follows.

    A table of a few files, or of one, is read by as many tasks; where they are fewer than the cores its rows
    are dealt out again. A table of many files stays as it is. For frames that need no shuffle only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for a session, unless they find it where the driver does.

    Functions that run in Python workers are found by name there, so the workers must be able to import them.
    """
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    known = {str(Path(p).resolve()) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(root) in known or (sc.master.startswith("local") and not sc.master.startswith("local-cluster") and Path.cwd() == root):
        return
    if getattr(sc, "_loamline_sent", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="loamline-"), "loamline.zip")
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted((root / "loamline").rglob("*.py")):
            z.write(file, str(file.relative_to(root)))
    sc.addPyFile(target)
    sc._loamline_sent = True
