"""A table laid out in the order its readers ask for it, with the range of each file.

Rows are range-partitioned and sorted by the leading columns, so a slice lies in few files. A small table of
each file's first and last value says which, so the others are not even opened. Inside a file Parquet's
own statistics skip row groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Clustered:
    """Folders of the rows and of the files' ranges, and the columns that lead the order."""

    rows: str
    ranges: str
    by: tuple[str, ...]


def write_clustered(
    rows: DataFrame, table: Clustered, then: list[str] = (), rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write the rows in order of the leading columns and ``then`` further ones, which split a value that
    very many rows share. ``rows`` is read three times, so stored. Null comes first."""
    spark = rows.sparkSession
    n_files = max(1, -(-rows.count() // rows_per_file))
    order = [*table.by, *then]
    rows.repartitionByRange(n_files, *order).sortWithinPartitions(*order).write.parquet(table.rows)
    value = F.struct(*table.by)
    spark.read.schema(rows.schema).parquet(table.rows).groupBy(
        F.col("_metadata.file_path").alias("path")
    ).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n_rows")
    ).write.parquet(table.ranges)


def files_of(spark: SparkSession, table: Clustered, wanted: list[tuple]) -> list[str]:
    """Files that can hold one of the wanted values of the leading columns; one short path per file."""
    ranges = spark.read.parquet(table.ranges)
    kind = ranges.schema["low"].dataType
    # The values of one reader or of a group of them.
    asked = F.array(*[
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, kind.fields)]) for value in wanted
    ])
    inside = F.exists(asked, lambda w: (w >= F.col("low")) & (w <= F.col("high")))
    return [r.path for r in ranges.filter(inside).select("path").collect()] if wanted else []


def read_slice(spark: SparkSession, table: Clustered, wanted: list[tuple]) -> DataFrame:
    """Rows with one of the wanted values of the leading columns, from the files that can hold them."""
    paths = files_of(spark, table, wanted)
    whole = spark.read.parquet(table.rows)
    if not paths:
        return whole.limit(0)
    rows = spark.read.schema(whole.schema).parquet(*paths)
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    asked = spark.createDataFrame(
        [tuple(value) for value in set(wanted)],
        ", ".join(f"_{c} {kinds[c].simpleString()}" for c in table.by),
    )
    same = F.lit(True)
    for column in table.by:
        same &= F.col(column).eqNullSafe(F.col(f"_{column}"))
    return rows.join(F.broadcast(asked), same, "left_semi")  # the values handed in
