"""Dates delivered as spreadsheet serials or as text."""

from __future__ import annotations

SERIAL_ZERO = "1899-12-30"
LAST_SERIAL = 2958465  # 9999-12-31

_CLOCK = r"(?:[ T](?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.][0-9]{1,7})?)?)?"
SERIAL = r"^([0-9]+[.]?[0-9]*|[.][0-9]+)\z"
COMPACT = r"((?:19|20|21)[0-9]{2})([0-9]{2})([0-9]{2})"
YEAR_FIRST = r"((?!0000)[0-9]{4})([./-])([0-9]{1,2})\5([0-9]{1,2})" + _CLOCK
DAY_FIRST = r"([0-9]{1,2})([./-])([0-9]{1,2})\9((?!0000)[0-9]{4})"
# The groups of the form that fits are year-month-day; of any other text only the hyphens are left.
WRITTEN = rf"^(?:{COMPACT}|{YEAR_FIRST}|{DAY_FIRST})\z|^(?s:.+)\z"
YEAR_MONTH_DAY = "$1$4$11-$2$6$10-$3$7$8"


def _written_date(text: str) -> str:
    """Every written form is brought to year-month-day in one pass; anything else becomes null."""
    return f"try_cast(regexp_replace({text}, r'{WRITTEN}', '{YEAR_MONTH_DAY}') AS date)"


def _serial_date(text: str) -> str:
    """Days since the zero day: rounded to two digits, then floored; too late ones are null."""
    day = f"floor(try_cast(regexp_extract({text}, r'{SERIAL}', 0) AS decimal(18,2)))"
    # The lambda names the number, so that the text is looked at once.
    in_range = f"get(filter(array({day}), day -> day <= {LAST_SERIAL}), 0)"
    return f"date_add(DATE'{SERIAL_ZERO}', int({in_range}))"


def parse_date(cell: str) -> str:
    """yyyyMMdd and the other written forms, else a serial; both sets of texts are disjoint.

    Eight digits that form no date are a serial beyond the calendar. Such serials give null, so
    the row goes to quarantine with its reason.
    """
    text = f"trim({cell})"
    return f"coalesce({_written_date(text)}, {_serial_date(text)})"


def month_key(year: str, month: str) -> str:
    return f"{year} * 100 + {month}"


def previous_month_key(key: str) -> str:
    """202401 -> 202312, 202402 -> 202401."""
    return f"CASE WHEN {key} % 100 = 1 THEN {key} - 89 ELSE {key} - 1 END"
