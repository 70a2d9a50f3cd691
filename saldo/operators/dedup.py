"""First delivery of a business key wins; nothing is ever ranked inside one big group.

The winner of a key is a plain minimum, combined on the map side together with a count. Only keys
that occur again, or that the clean layer holds already (see ``sources/keyindex.py``), meet the rows
again. They are usually few and are broadcast. Where they are many, adaptive execution splits
the partition of a key that was delivered very often. So the rows are read twice, whatever they hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BUSINESS_KEYS
from .rules import DUPLICATE


def first_loads(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the key, the lowest load_id and the number of rows."""
    return rows.groupBy(*keys).agg(F.min("load_id").alias("first"), F.count("*").alias("n"))


def losing_keys(
    checked: DataFrame, feed: str, known_keys: Callable[[DataFrame], DataFrame] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Keys of sound rows that hold duplicates, with ``first``: the load_id that is none, null if all are.

    ``known_keys`` gives those of some distinct keys that the clean layer holds already, each once. ``keep``
    stores the first loads, which are then needed twice.
    """
    keys = BUSINESS_KEYS[feed]
    winners = first_loads(checked.filter("error_reason IS NULL"), keys)
    if known_keys is None:
        return winners.filter("n > 1").select(*keys, "first")
    winners = keep(winners) if keep else winners
    known = known_keys(winners.select(*keys)).withColumn("known", F.lit(True))
    return winners.join(known, keys, "left").filter("known OR n > 1").selectExpr(
        *keys, "if(known, cast(NULL AS long), first) AS first"
    )


def mark_duplicates(checked: DataFrame, feed: str, losing: DataFrame) -> DataFrame:
    """Sound rows of these keys, but the first one, get the reason; other rows keep theirs."""
    keys = BUSINESS_KEYS[feed]
    repeated = "error_reason IS NULL AND _mark AND (first IS NULL OR load_id <> first)"
    marked = checked.join(losing.select(*keys, "first", F.lit(True).alias("_mark")), keys, "left")
    reason = f"if({repeated}, '{DUPLICATE}', error_reason) AS error_reason"
    return marked.selectExpr(*[c if c != "error_reason" else reason for c in checked.columns])


def flag_duplicates(
    checked: DataFrame, feed: str, known_keys: Callable[[DataFrame], DataFrame] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    keep_losing: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``keep_losing`` stores the losing keys: what was moved to find them goes before whole rows are moved."""
    losing = losing_keys(checked, feed, known_keys, keep)
    return mark_duplicates(checked, feed, keep_losing(losing) if keep_losing else losing)


def unseen(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet; used before an append."""
    return rows.join(stored.select(*keys), keys, "left_anti")
