"""Expression helpers.

Each takes a column name or other SQL expression text and returns SQL expression text, for use in
``selectExpr``, ``filter`` or ``F.expr``. All are native, so they stay inside code generation.
"""

from .cells import blank_to_null, to_int, to_price, to_qty
from .dates import month_key, parse_date, previous_month_key
from .numbers import ratio, safe_ratio

__all__ = [
    "blank_to_null", "to_int", "to_price", "to_qty", "month_key", "parse_date",
    "previous_month_key", "ratio", "safe_ratio",
]
