"""Column lists and types of the three feeds, per layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the delivered feeds.
TURNOVER_COLUMNS = [
    "date", "start_date", "end_date", "warehouse_code", "material_id", "unit",
    "balance_start", "income_qty", "expense_qty", "balance_end",
]
PRICES_COLUMNS = ["date", "start_date", "end_date", "material_id", "price"]
WAREHOUSES_COLUMNS = [
    "date", "start_date", "end_date", "warehouse_code", "shop_code", "warehouse_type",
    "directorate", "mol_id", "mol_position",
]

FEED_COLUMNS = {
    "turnover": TURNOVER_COLUMNS,
    "prices": PRICES_COLUMNS,
    "warehouses": WAREHOUSES_COLUMNS,
}

# Unique business key of a clean row.
BUSINESS_KEYS = {
    "turnover": ["date", "material_id", "warehouse_code", "start_date", "end_date"],
    "prices": ["date", "material_id", "start_date", "end_date"],
    "warehouses": ["date", "warehouse_code", "start_date", "end_date"],
}

QUANTITIES = ["balance_start", "income_qty", "expense_qty", "balance_end"]
WAREHOUSE_ATTRIBUTES = ["shop_code", "warehouse_type", "directorate", "mol_id", "mol_position"]


def raw_schema(feed: str) -> T.StructType:
    """Every delivered column is text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in feed_columns(feed)])


def feed_columns(feed: str) -> list[str]:
    if feed not in FEED_COLUMNS:
        raise ValueError(f"unknown feed {feed!r}, expected one of {sorted(FEED_COLUMNS)}")
    return FEED_COLUMNS[feed]


REGISTRY_SCHEMA = T.StructType([
    T.StructField("source_type", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
    # When the file was changed last, as its listing said.
    T.StructField("modified_at", T.TimestampType()),
])

QTY = "decimal(18,3)"
MONEY = "decimal(18,2)"
SHARE = "decimal(18,4)"
