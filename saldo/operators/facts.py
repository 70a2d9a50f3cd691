"""Facts: the latest export of a period wins, keys come from the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY, QUANTITIES
from .calendar import with_date_keys
from .material import MATERIAL_SK, with_material_key
from .merge import changes, upsert
from .warehouse import resolve_version

INVENTORY_KEYS = ["date_key_start", "date_key_end", "warehouse_sk", "material_sk"]
PRICE_KEYS = ["date_key_start", "date_key_end", "material_sk"]
TURNOVER_GROUP = ["start_date", "end_date", "warehouse_code", "material_id"]
PRICE_GROUP = ["start_date", "end_date", "material_id"]

# Fixed value: stands for "no price" in the change test of prices.
NO_PRICE = "-999999999.99"

# Export date, then load order, as one number. A flat decimal keeps the aggregate below a hash
# aggregate with a map-side part; ordering by a struct would turn it into a sort.
EXPORT_ORDER = "unix_date(date) * 10000000000000000000BD + load_id AS export_order"


def _latest(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return rows.selectExpr("*", EXPORT_ORDER).groupBy(*keys).agg(
        F.max("date").alias("date"),
        *[F.max_by(m, "export_order").alias(m) for m in measures],
    )


def latest_turnover(turnover: DataFrame) -> DataFrame:
    return _latest(turnover, TURNOVER_GROUP, QUANTITIES)


def latest_prices(prices: DataFrame) -> DataFrame:
    return _latest(prices, PRICE_GROUP, ["price"])


def _keyed(rows: DataFrame, calendar: DataFrame, materials: DataFrame | None) -> DataFrame:
    """Without ``materials`` every id is taken as known, as right after the dimension load."""
    dated = with_date_keys(rows, calendar)
    if materials is None:
        return dated.selectExpr("*", MATERIAL_SK)
    return with_material_key(dated, materials)


def inventory_rows(
    turnover: DataFrame, calendar: DataFrame, versions: DataFrame,
    materials: DataFrame | None = None,
) -> DataFrame:
    """One fact row per period, warehouse version and material, at two digits.

    ``turnover`` should be a stored table: a large dimension reads its codes and days on their own.
    """
    keyed = _keyed(latest_turnover(turnover), calendar, materials)
    return resolve_version(keyed, versions, turnover).selectExpr(
        *INVENTORY_KEYS, *[f"cast({m} AS {MONEY}) AS {m}" for m in QUANTITIES]
    )


def price_rows(
    prices: DataFrame, calendar: DataFrame, materials: DataFrame | None = None
) -> DataFrame:
    keyed = _keyed(latest_prices(prices), calendar, materials)
    return keyed.selectExpr(*PRICE_KEYS, f"cast(price AS {MONEY}) AS price")


def inventory_changes(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    return changes(stored, arriving, INVENTORY_KEYS, QUANTITIES, f"cast(0 AS {MONEY})")


def price_changes(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    return changes(stored, arriving, PRICE_KEYS, ["price"], NO_PRICE)


def upsert_inventory(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    return upsert(stored, arriving, INVENTORY_KEYS, QUANTITIES, f"cast(0 AS {MONEY})")


def upsert_prices(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    return upsert(stored, arriving, PRICE_KEYS, ["price"], NO_PRICE)
