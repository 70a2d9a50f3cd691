"""Row checks: every broken rule adds its text to the reason of the row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null
from ..schemas import feed_columns

# Reason texts as users of the quarantine know them.
SEPARATOR = "; "
BAD = "Некорректная {}"
BAD_M = "Некорректный {}"
EMPTY = "Пустой {}"
UNBALANCED = "Несоответствие остатков и движений"
DUPLICATE = "Дубликат строки в staging"

BALANCE_TOLERANCE = "0.001"

# (condition that breaks the rule, text)
Rule = tuple[str, str]

BALANCE_GAP = "abs(balance_start + income_qty + expense_qty - balance_end)"
UNBALANCED_ROW = f"{BALANCE_GAP} > {BALANCE_TOLERANCE}"


def _missing(text: str, *columns: str) -> list[Rule]:
    return [(f"{c} IS NULL", text.format(c)) for c in columns]


def _forbidden(*conditions: str) -> list[Rule]:
    """Rules whose text is the condition itself."""
    return [(c, c) for c in conditions]


DATES = _missing(BAD, "date", "start_date", "end_date")
PERIOD = _forbidden("start_date > end_date")

TURNOVER_RULES = [
    *DATES,
    *_missing(BAD_M, "material_id", "balance_start", "income_qty", "expense_qty", "balance_end"),
    *_missing(EMPTY, "warehouse_code", "material_id", "unit"),
    *PERIOD,
    *_forbidden(
        "material_id <= 0", "income_qty < 0", "expense_qty > 0", "balance_start < 0",
        "balance_end < 0",
    ),
    (UNBALANCED_ROW, UNBALANCED),
]
PRICE_RULES = [
    *DATES,
    *_missing(BAD_M, "material_id", "price"),
    *PERIOD,
    *_forbidden("material_id <= 0", "price <= 0"),
]
# The responsible person may be absent, but not unreadable.
WAREHOUSE_RULES = [
    *DATES,
    *_missing(EMPTY, "warehouse_code", "warehouse_type"),
    (f"mol_id IS NULL AND {blank_to_null('raw_mol_id')} IS NOT NULL", BAD_M.format("mol_id")),
    *_forbidden("mol_id <= 0"),
    *PERIOD,
]
RULES = {"turnover": TURNOVER_RULES, "prices": PRICE_RULES, "warehouses": WAREHOUSE_RULES}


def error_reason(rules: list[Rule]) -> str:
    """All texts of broken rules in rule order, null for a sound row."""
    texts = ", ".join(f"CASE WHEN {broken} THEN '{text}' END" for broken, text in rules)
    return f"nullif(concat_ws('{SEPARATOR}', {texts}), '')"


def with_reason(cleaned: DataFrame, feed: str) -> DataFrame:
    return cleaned.withColumn("error_reason", F.expr(error_reason(RULES[feed])))


def split_valid(checked: DataFrame, feed: str) -> DataFrame:
    """Sound rows with typed values, as the clean layer stores them."""
    return checked.filter("error_reason IS NULL").select("load_id", *feed_columns(feed))


def split_quarantine(checked: DataFrame, feed: str) -> DataFrame:
    """Broken rows with the values exactly as delivered."""
    raw = [f"raw_{c} AS {c}" for c in feed_columns(feed)]
    return checked.filter("error_reason IS NOT NULL").selectExpr(
        "load_id", "file_name", "error_reason", *raw
    )
