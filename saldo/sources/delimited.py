"""Delimited exports: `;`, quote `"`, UTF-16, one header line skipped by position."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import feed_columns, raw_schema
from ..session import brief_shuffles
from .files import plain_path
from .quoted import PIECE, scan_quoted
from .quoted import ROW as PLACE

_FORM = {"sep": ";", "quote": '"', "escape": '"', "header": "true"}
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

_OPTIONS = {k: v for k, v in {**_FORM, **_KEEP_BLANKS}.items() if k != "header"}


def scan(
    spark: SparkSession,
    feed: str,
    paths: str | list[str],
    encoding: str = "UTF-16LE",
    splittable: bool = True,
    positions: bool = False,
    quoted_breaks: bool = False,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All columns as text, plus ``file_name``.

    Large files are cut at line ends; that is for UTF-16LE, with or without a byte-order mark. If cells may
    hold line breaks inside quotes, ``quoted_breaks`` finds out which line ends end a row; ``keep`` then
    stores the lines on the way. Files in another byte order need ``splittable=False`` and are read by one task
    each; then ``encoding="UTF-16"`` follows the byte-order mark. ``positions`` adds the place of
    each row, for ``with_load_id``.
    """
    if quoted_breaks and splittable:
        rows = scan_quoted(spark, paths, raw_schema(feed).simpleString()[7:-1].replace(":", " "), _OPTIONS, keep)
        place = [F.col(PIECE).alias(BLOCK), F.col(PLACE).cast("long").alias(ROW)]
        return rows.select("file_name", *(place if positions else []), *feed_columns(feed))
    reader = spark.read.schema(raw_schema(feed)).options(
        **_FORM, **_KEEP_BLANKS, enforceSchema="true", mode="PERMISSIVE"
    )
    if splittable:
        reader = reader.options(encoding="UTF-16LE", lineSep="\n")
    else:
        reader = reader.options(encoding=encoding, multiLine="true")
    rows = reader.csv(paths)
    place = [F.col("_metadata.file_block_start").alias(BLOCK), F.monotonically_increasing_id().alias(ROW)]
    return rows.select(
        plain_path(F.col("_metadata.file_path")).alias("file_name"), *(place if positions else []),
        *feed_columns(feed),
    )


# Where a block of a file begins, and a number that rises within the block.
BLOCK, ROW = "_block", "_row"


def with_load_id(rows: DataFrame, previous_max: int = -1) -> DataFrame:
    """Numbers above those of earlier loads, without gaps, by path, block of the file and row in it.

    ``rows`` is a stored ``scan(..., positions=True)``. Only the blocks are put in order, one row
    for each.
    """
    blocks = rows.groupBy("file_name", BLOCK).agg(F.min(ROW).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.orderBy("file_name", BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    number = F.col("_before") + F.col(ROW) - F.col("_first") + F.lit(previous_max + 1).cast("long")
    kept = [c for c in rows.columns if c not in (BLOCK, ROW)]
    # One row per piece of a file.
    return rows.join(F.broadcast(blocks), ["file_name", BLOCK]).select(number.alias("load_id"), *kept)


def export(rows: DataFrame, feed: str, folder: str) -> None:
    """Write the feed's columns as delimited UTF-16LE files that ``scan`` reads back."""
    with brief_shuffles(rows.sparkSession):
        rows.select(*feed_columns(feed)).write.mode("errorifexists").options(
            **_FORM, **_KEEP_BLANKS, encoding="UTF-16LE", lineSep="\n", emptyValue=""
        ).csv(folder)
