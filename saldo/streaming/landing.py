"""Loads driven by a file stream: each delivered file is loaded once, whatever dies in between.

A Structured Streaming file source remembers in its checkpoint which files it has handed out, so neither the
stored registry nor old files are looked at to find the new ones. Every micro-batch is one load, and its
commit records the number of the micro-batch. A run that died before the commit repeats the same files;
one that died between the commit and the checkpoint finds the number and goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.nightly import FilesFailed, Options, run_nightly
from ..sources.files import plain_path
from ..sources.layers import Layers

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# The number of the last micro-batch that was loaded, in the commit record.
LAST_BATCH = "stream/batch"


def delivered_files(spark: SparkSession, landing: str, files_per_load: int) -> DataFrame:
    """Stream of the files below the landing folder, in the order of their time."""
    found = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_load)
        .option("maxFileAge", "36500d")  # files are taken however late they are found
        .load(f"{landing.rstrip('/')}/*")
    )
    # Only names are asked for, so the contents are not read here.
    return found.select(plain_path(F.col("_metadata.file_path")).alias("path"))


def load_stream(
    spark: SparkSession, landing: str, state: str, checkpoint: str, options: Options | None = None,
    files_per_load: int = 10_000,
) -> Layers:
    """Load all files delivered to ``<landing>/<feed>/*.csv`` since the last run; returns the layers.

    A file is known by its path: a corrected file needs a new name. Files that cannot be read are recorded as
    failed and not tried again; the run raises FilesFailed once all others are loaded.
    """
    options = options or Options()
    unread: list[str] = []

    def load(batch: DataFrame, number: int) -> None:
        if Layers(spark, state).numbers.get(LAST_BATCH, -1) >= number:
            return  # committed by a run that died before the stream could note it
        # One short row per file of this micro-batch.
        paths = [r.path for r in batch.collect()]
        delivered = {
            feed: own for feed, folder in options.folders.items()
            if (own := [p for p in paths if p.rsplit("/", 2)[-2] == folder])
        }
        try:
            run_nightly(spark, landing, state, options, delivered, {LAST_BATCH: number})
        except FilesFailed as failed:
            unread.append(str(failed))

    stream = delivered_files(spark, landing, files_per_load).writeStream.foreachBatch(load)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if unread:
        raise FilesFailed("; ".join(unread))
    return Layers(spark, state)
