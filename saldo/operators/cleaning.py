"""Raw text beside its typed twin, one row in, one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import blank_to_null, parse_date, to_int, to_price, to_qty
from ..schemas import feed_columns

_CONVERTERS = {
    "date": parse_date,
    "start_date": parse_date,
    "end_date": parse_date,
    "warehouse_code": blank_to_null,
    "unit": blank_to_null,
    "shop_code": blank_to_null,
    "warehouse_type": blank_to_null,
    "directorate": blank_to_null,
    "mol_position": blank_to_null,
    "material_id": to_int,
    "mol_id": to_int,
    "balance_start": to_qty,
    "income_qty": to_qty,
    "expense_qty": to_qty,
    "balance_end": to_qty,
    "price": to_price,
}


def clean(staged: DataFrame, feed: str, fold_codes: bool = False) -> DataFrame:
    """load_id, file_name, raw_<column> as delivered, <column> as converted.

    With ``fold_codes`` warehouse codes are in upper case, so that spellings which differ by case or
    trailing blanks are one code everywhere; the delivered spelling stays in the raw twin.
    """
    columns = feed_columns(feed)
    converted = {c: _CONVERTERS[c](c) for c in columns}
    # Cells of one kind are converted by one expression over an array. Written out column by column, the
    # generated method outgrows what the JVM compiles, and each row costs several times as much.
    alike: dict = {}
    for c in columns:
        if _CONVERTERS[c] in (parse_date, to_qty):
            alike.setdefault(_CONVERTERS[c], []).append(c)
    arrays = []
    for number, (convert, cells) in enumerate(alike.items()):
        arrays.append(f"transform(array({', '.join(cells)}), cell -> {convert('cell')}) AS _converted{number}")
        converted.update({c: f"_converted{number}[{place}]" for place, c in enumerate(cells)})
    if fold_codes and "warehouse_code" in converted:
        converted["warehouse_code"] = f"upper({converted['warehouse_code']})"
    return staged.selectExpr("load_id", "file_name", *columns, *arrays).selectExpr(
        "load_id",
        "file_name",
        *[f"{c} AS raw_{c}" for c in columns],
        *[f"{text} AS {c}" for c, text in converted.items()],
    )
