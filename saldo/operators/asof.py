"""The version of a key that is valid on a day, for a dimension of any size.

A dimension small enough for a broadcast is left to Spark as a range join in each task. A larger one is
merged as of: the distinct days asked for and the beginnings of the versions are put in order per
key, and the version that began last is carried along. A key has at most one row per day on either side there,
however many rows ask, so no key runs hot, and no row ever meets the other versions of its key. The rows
themselves then meet one answer for their key and day. That is an equi join whose large partitions
adaptive execution splits, as a single key and day may hold any part of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FROM, TO = "date_from", "date_to"


def sent_whole(lookup: DataFrame) -> bool:
    """Whether Spark broadcasts the lookup by its size; never where the threshold is off."""
    limit = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def disjoint(versions: DataFrame, key: str) -> DataFrame:
    """Versions cut where the next one of their key begins, so that a day has one version at most."""
    following = f"lead({FROM}) OVER (PARTITION BY {key} ORDER BY {FROM}, {TO})"
    cut = versions.selectExpr("*", f"least({TO}, date_sub({following}, 1)) AS _last")
    return cut.filter(f"{FROM} <= _last").withColumn(TO, F.col("_last")).select(*versions.columns)


def versions_on_days(days: DataFrame, versions: DataFrame, key: str, day: str) -> DataFrame:
    """One row per distinct key and day that has a valid version, with the version's other columns.

    ``versions`` are disjoint. Days are compared within their key only.
    """
    values = [c for c in versions.columns if c not in (key, FROM, TO)]
    asked = days.filter(f"{key} IS NOT NULL AND {day} IS NOT NULL").selectExpr(key, f"{day} AS _day")
    begun = versions.selectExpr(
        key, f"{FROM} AS _day", f"struct({TO} AS _last, {', '.join(values)}) AS _version"
    )
    # On one day a version begins before the question is put.
    marks = begun.withColumn("_asked", F.lit(False)).unionByName(
        asked.distinct().withColumn("_asked", F.lit(True)), allowMissingColumns=True
    )
    carried = marks.selectExpr(
        key, "_day", "_asked",
        f"last(_version, true) OVER (PARTITION BY {key} ORDER BY _day, _asked "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _version",
    )
    return carried.filter("_asked AND _day <= _version._last").selectExpr(
        key, f"_day AS {day}", *[f"_version.{v} AS {v}" for v in values]
    )


def as_of(
    rows: DataFrame, versions: DataFrame, key: str, day: str, days: DataFrame | None = None
) -> DataFrame:
    """Add the columns of the version of ``key`` that is valid on ``day``, null where none is.

    ``versions`` has the key, date_from and date_to (both inclusive) and the columns to add, and is disjoint.
    ``days`` is a stored table whose keys and days include those of the rows; without it the rows are
    read twice, once for their days.
    """
    values = [c for c in versions.columns if c not in (key, FROM, TO)]
    if sent_whole(versions):
        valid = F.expr(f"{key} = _key AND {day} BETWEEN {FROM} AND {TO}")
        found = rows.join(versions.withColumnRenamed(key, "_key"), valid, "left")
    else:
        asked = rows if days is None else days
        found = rows.join(versions_on_days(asked.select(key, day), versions, key, day), [key, day], "left")
    return found.select(*rows.columns, *values)
