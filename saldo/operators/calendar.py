"""The calendar dimension and the role-playing date lookups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names and default bounds of the calendar.
MONTH_NAMES = [
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
]
FIRST_DAY = date(2023, 1, 1)
LAST_DAY = date(2026, 12, 31)


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day; weeks start on Monday."""
    days = (last - first).days + 1
    if days <= 0:
        raise ValueError(f"calendar from {first} to {last}")
    names = ", ".join(f"'{n}'" for n in MONTH_NAMES)
    day = spark.range(0, days, numPartitions=1).selectExpr(
        f"date_add(DATE'{first.isoformat()}', int(id)) AS full_date"
    )
    return day.selectExpr(
        "year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS date_key",
        "full_date",
        "year(full_date) AS year_num",
        "quarter(full_date) AS quarter_num",
        "month(full_date) AS month_num",
        f"element_at(array({names}), month(full_date)) AS month_name",
        "day(full_date) AS day_of_month",
        "weekday(full_date) + 1 AS day_of_week",
        "weekday(full_date) >= 5 AS is_weekend",
    )


def with_date_keys(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keys of the period's first and last day; rows outside the calendar drop out."""
    starts = calendar.selectExpr("full_date AS start_date", "date_key AS date_key_start")
    ends = calendar.selectExpr("full_date AS end_date", "date_key AS date_key_end")
    # One row per day: the years 1 to 9999 are 3.7 million short rows, so it is always sent whole.
    return rows.join(F.broadcast(starts), "start_date").join(F.broadcast(ends), "end_date")


def outside_calendar(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows that with_date_keys drops."""
    starts = calendar.selectExpr("full_date AS start_date", "true AS start_known")
    ends = calendar.selectExpr("full_date AS end_date", "true AS end_known")
    joined = rows.join(F.broadcast(starts), "start_date", "left").join(
        F.broadcast(ends), "end_date", "left"
    )
    return joined.filter("start_known IS NULL OR end_known IS NULL").drop(
        "start_known", "end_known"
    )
