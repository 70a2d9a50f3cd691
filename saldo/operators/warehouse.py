"""Warehouse dimension with history (type 2) and unknown members.

After ``snapshots`` a warehouse has at most one row per calendar day, so the windows over one
code below sort a few hundred rows, however many rows were delivered for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import WAREHOUSE_ATTRIBUTES
from .asof import as_of, disjoint

# Fixed values of the dimension.
OPEN_END = "DATE'9999-12-31'"
UNKNOWN_FROM = "DATE'1900-01-01'"
UNKNOWN_SHOP = "—"
UNKNOWN_TYPE = "UNKNOWN"
UNKNOWN_DIRECTORATE = "Не определена"

FIRST_POSSIBLE = "DATE'0001-01-01'"
VERSION_COLUMNS = [
    "warehouse_sk", "warehouse_code", *WAREHOUSE_ATTRIBUTES, "date_from", "date_to", "is_current",
]
WAREHOUSE_SK = "xxhash64(warehouse_code, date_from) AS warehouse_sk"
BY_DAY = "OVER (PARTITION BY warehouse_code ORDER BY snapshot_date)"

# The five attributes as one value in which null and empty are the same.
STATE = "struct({})".format(", ".join(
    f"coalesce({c}, {-1 if c == 'mol_id' else repr('')})" for c in WAREHOUSE_ATTRIBUTES
))


def _keyed(versions: DataFrame) -> DataFrame:
    return versions.selectExpr("*", WAREHOUSE_SK).select(*VERSION_COLUMNS)


def snapshots(warehouses: DataFrame) -> DataFrame:
    """One row per warehouse and export day: the one loaded first."""
    known = warehouses.filter("warehouse_code IS NOT NULL AND date IS NOT NULL")
    first = known.groupBy("warehouse_code", "date").agg(F.min("load_id").alias("load_id"))
    return known.join(first.select("load_id"), "load_id", "left_semi").selectExpr(
        "warehouse_code", *WAREHOUSE_ATTRIBUTES, "date AS snapshot_date"
    )


def changes(daily: DataFrame) -> DataFrame:
    """Snapshots whose attributes differ from the previous snapshot, and each first one."""
    return (
        daily.selectExpr("*", f"{STATE} AS state")
        .selectExpr("*", f"lag(state) {BY_DAY} AS previous")
        .filter("previous IS NULL OR previous <> state")
        .drop("state", "previous")
    )


def build_versions(changed: DataFrame) -> DataFrame:
    """Each change is valid until the day before the next one."""
    followed = changed.selectExpr("*", f"lead(snapshot_date) {BY_DAY} AS following")
    return _keyed(followed.selectExpr(
        "warehouse_code",
        *WAREHOUSE_ATTRIBUTES,
        "snapshot_date AS date_from",
        f"coalesce(date_sub(following, 1), {OPEN_END}) AS date_to",
        "following IS NULL AS is_current",
    ))


def last_changes(changed: DataFrame) -> DataFrame:
    followed = changed.selectExpr("*", f"lead(snapshot_date) {BY_DAY} AS following")
    return followed.filter("following IS NULL").drop("following")


def pending_changes(stored: DataFrame, changed: DataFrame, strict: bool = True) -> DataFrame:
    """Last change per warehouse that is newer than its current version and differs from it.

    ``strict`` leaves out codes without a current version; they enter once turnover has made a
    placeholder for them. Otherwise they are opened at once.
    """
    current = stored.filter("is_current").selectExpr(
        "warehouse_code", "date_from AS current_from", f"{STATE} AS current_state"
    )
    joined = last_changes(changed).join(current, "warehouse_code", "inner" if strict else "left")
    moved = f"(snapshot_date > current_from AND current_state <> {STATE})"
    if not strict:
        moved = f"{moved} OR current_from IS NULL"
    return joined.filter(moved).drop("current_from", "current_state")


def close_versions(stored: DataFrame, pending: DataFrame) -> DataFrame:
    """All stored versions; the current one of a changed warehouse ends the day before."""
    next_day = pending.selectExpr("warehouse_code", "snapshot_date AS next_from")
    ends = "is_current AND next_from IS NOT NULL"
    kept = [c for c in VERSION_COLUMNS if c not in ("date_to", "is_current")]
    return stored.join(next_day, "warehouse_code", "left").selectExpr(
        *kept,
        f"CASE WHEN {ends} THEN date_sub(next_from, 1) ELSE date_to END AS date_to",
        f"is_current AND NOT ({ends}) AS is_current",
    )


def open_versions(pending: DataFrame) -> DataFrame:
    return _keyed(pending.selectExpr(
        "warehouse_code", *WAREHOUSE_ATTRIBUTES, "snapshot_date AS date_from",
        f"{OPEN_END} AS date_to", "true AS is_current",
    ))


def increment_versions(stored: DataFrame, changed: DataFrame, strict: bool = True) -> DataFrame:
    pending = pending_changes(stored, changed, strict)
    return close_versions(stored, pending).unionByName(open_versions(pending))


def unknown_members(turnover: DataFrame, versions: DataFrame) -> DataFrame:
    """An always-valid placeholder for every code that only turnover mentions."""
    codes = turnover.filter("warehouse_code IS NOT NULL").select("warehouse_code").distinct()
    missing = codes.join(versions.select("warehouse_code"), "warehouse_code", "left_anti")
    return _keyed(missing.selectExpr(
        "warehouse_code",
        f"'{UNKNOWN_SHOP}' AS shop_code",
        f"'{UNKNOWN_TYPE}' AS warehouse_type",
        f"'{UNKNOWN_DIRECTORATE}' AS directorate",
        "cast(NULL AS int) AS mol_id",
        "cast(NULL AS string) AS mol_position",
        f"{UNKNOWN_FROM} AS date_from",
        f"{OPEN_END} AS date_to",
        "true AS is_current",
    ))


def with_unknown(versions: DataFrame, turnover: DataFrame) -> DataFrame:
    return versions.unionByName(unknown_members(turnover, versions))


def version_on_date(
    rows: DataFrame, versions: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Add the version valid on the export date and its first day, null where none is.

    If versions of a code overlap, the one that begins later is meant. ``days``: see ``as_of``.
    """
    lookup = disjoint(versions, "warehouse_code").selectExpr(
        "warehouse_code", "date_from", "date_to", "warehouse_sk", "date_from AS version_from"
    )
    return as_of(rows, lookup, "warehouse_code", "date", days).withColumnRenamed("version_from", "date_from")


def gap_free(versions: DataFrame) -> DataFrame:
    """Intervals that cover all time: the versions, and the current version in every gap.

    ``version_from`` is the first day of the version that an interval stands for.
    Resolving against these needs one join where "valid on the day, else current" needs two.
    """
    by_code = "PARTITION BY warehouse_code"
    earlier = "ORDER BY date_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    known = disjoint(versions, "warehouse_code").selectExpr(
        "warehouse_code", "date_from", "date_to", "warehouse_sk",
        f"max(date_to) OVER ({by_code} {earlier}) AS reach",
        f"lead(date_from) OVER ({by_code} ORDER BY date_from) IS NULL AS is_last",
        f"max(CASE WHEN is_current THEN warehouse_sk END) OVER ({by_code}) AS current_sk",
        f"max(CASE WHEN is_current THEN date_from END) OVER ({by_code}) AS current_from",
    )

    def interval(first: str, last: str, sk: str, version_from: str) -> str:
        return (
            f"named_struct('date_from', {first}, 'date_to', {last}, 'warehouse_sk', {sk}, "
            f"'version_from', {version_from})"
        )

    own = interval("date_from", "date_to", "warehouse_sk", "date_from")
    before = interval(
        f"coalesce(date_add(reach, 1), {FIRST_POSSIBLE})", "date_sub(date_from, 1)", "current_sk",
        "current_from",
    )
    after = interval(
        "date_add(greatest(reach, date_to), 1)", f"if(is_last, {OPEN_END}, {FIRST_POSSIBLE})",
        "current_sk", "current_from",
    )
    return known.selectExpr(
        "warehouse_code",
        f"inline(filter(array({own}, {before}, {after}), i -> i.date_from <= i.date_to))",
    )


def resolve_version(
    rows: DataFrame, versions: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Add the version valid on the export date, or else the current one, and its first day."""
    found = as_of(rows, gap_free(versions), "warehouse_code", "date", days)
    return found.withColumnRenamed("version_from", "date_from")
