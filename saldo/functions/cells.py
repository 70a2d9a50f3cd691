"""Text cells to typed values; whatever does not convert becomes null."""

from __future__ import annotations

# Plain decimal notation only: no exponent, no decimal comma.
PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)\z"


def blank_to_null(cell: str) -> str:
    return f"nullif(trim({cell}), '')"


def to_decimal(cell: str, precision: int, scale: int) -> str:
    """Null where the text is no plain number."""
    # No match is an empty text here, which is no number either.
    number = f"regexp_extract(trim({cell}), r'{PLAIN_NUMBER}', 0)"
    return f"try_cast({number} AS decimal({precision},{scale}))"


def to_int(cell: str) -> str:
    """'391' and '391.0' are 391: rounded to two digits, then cut."""
    return f"try_cast({to_decimal(cell, 18, 2)} AS int)"


def to_qty(cell: str) -> str:
    """Three digits, because balances must be checked before any rounding to two."""
    return to_decimal(cell, 18, 3)


def to_price(cell: str) -> str:
    return to_decimal(cell, 18, 2)
