"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Months of a table are folders of their own; listing them is no job as long as they are few.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "saldo", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Shuffle files are removed when the query that wrote them has ended, not when the driver next collects garbage.
BRIEF_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A hot key's partition of a join is split even where the rows have to be moved once more afterwards.
SPLIT_ALWAYS = "spark.sql.adaptive.forceOptimizeSkewedJoin"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within this, steps that write their result leave no shuffle files on the executors' disks.

    A job of many steps would else hold the shuffles of all of them at once.
    """
    before = {name: spark.conf.get(name, None) for name in (BRIEF_SHUFFLES, SPLIT_ALWAYS)}
    for name in before:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that no later step reads, before the process ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. A job with a remote master fails
    without it: a folder of one machine would hide each executor's part from the others. Only a
    local master, as in tests, falls back to the warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    path = f"{root.rstrip('/')}/saldo-{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark._jvm, spark._jsc.hadoopConfiguration(), path))
    return path


# What this process has put into the shared folder; results may read it until the process ends.
_SCRATCH: list[tuple] = []


def _remove_scratch() -> None:
    for jvm, configuration, path in _SCRATCH:
        try:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(configuration).delete(folder, True)
        except (Py4JError, Py4JNetworkError, OSError):
            return  # the engine is gone already
