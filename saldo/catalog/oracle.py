"""SQL for DuckDB that computes the same results another way.

Windows stand where the Spark side aggregates, self joins where it uses windows, and a union of
levels where it uses grouping sets. Each block is a CTE; a statement takes the blocks it needs.
"""

from __future__ import annotations

import re

from ..operators.calendar import MONTH_NAMES
from .feeds import (
    BUNDLE, BUNDLE_LINES, CUT_DAYS, LINE_COLUMNS, LINES_PER_ORDER, LOADED_UNTIL, SNAPSHOT_DAYS, UNPRICED, UNREGISTERED,
)

BLOCKS: dict[str, str] = {}
# Blocks that several others read: computed once and stored.
MATERIALIZED = {
    "bounds", "calendar_days", "ods_turnover", "ods_prices", "ods_warehouses",
    "registered", "versions", "covering", "checked_turnover", "last_turnover",
    "fact_inventory", "upserted", "monthly", "metrics_now", "event_days", "early_versions",
}
ORACLE: dict[str, str] = {}


def _needed(sql: str, found: list[str]) -> list[str]:
    for word in re.findall(r"\b[a-z_0-9]+\b", sql):
        if word in BLOCKS and word not in found:
            _needed(BLOCKS[word], found)
            found.append(word)
    return found


def oracle(name: str, sql: str) -> None:
    blocks = ", ".join(
        f"{b} AS {'MATERIALIZED ' if b in MATERIALIZED else ''}({BLOCKS[b]})"
        for b in _needed(sql, [])
    )
    ORACLE[name] = f"WITH {blocks} {sql}" if blocks else sql


# --- functions ---------------------------------------------------------------------------------


def decimal_of(cell: str, scale: int) -> str:
    number = rf"regexp_extract(trim({cell}), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$')"
    return f"try_cast(nullif({number}, '') AS decimal(18,{scale}))"


def int_of(cell: str) -> str:
    return f"try_cast(trunc({decimal_of(cell, 2)}) AS integer)"


def date_of(cell: str) -> str:
    """Case by case, in the order in which the forms are tried."""
    t = f"trim({cell})"
    serial = decimal_of(cell, 2)
    day_first = r"^([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{4})$"
    year_first = r"^([0-9]{4})[./-]([0-9]{1,2})[./-]([0-9]{1,2})([ T][0-9:.]+)?$"
    return (
        f"CASE WHEN regexp_matches({t}, '^(19|20|21)[0-9]{{6}}$') "
        f"THEN try_cast({t}[1:4] || '-' || {t}[5:6] || '-' || {t}[7:8] AS date) "
        f"WHEN regexp_matches({t}, '^[0-9.]+$') AND {serial} IS NOT NULL THEN "
        f"CASE WHEN {serial} <= 2958465 THEN DATE '1899-12-30' + cast(floor({serial}) AS integer) END "
        f"WHEN regexp_matches({t}, '{day_first}') "
        f"THEN try_cast(regexp_replace({t}, '{day_first}', '\\3-\\2-\\1') AS date) "
        f"WHEN regexp_matches({t}, '{year_first}') "
        f"THEN try_cast(regexp_replace({t}, '{year_first}', '\\1-\\2-\\3') AS date) END"
    )


def whole_ratio(num: str, den: str, digits: int, scale: int = 2) -> str:
    """Exact rounding of num / den; both are turned into whole numbers of ``scale`` digits."""
    n = f"cast(({num}) * {10**scale} AS hugeint)"
    d = f"cast(({den}) * {10**scale} AS hugeint)"
    units = f"((abs({n}) * {2 * 10**digits} + abs({d})) // (2 * abs({d})))"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    value = f"cast(cast({units} * {sign} AS decimal(30,0)) * {10**-digits:.{digits}f} AS decimal(18,{digits}))"
    return f"CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN NULL ELSE {value} END"


def text_of(day: str) -> str:
    serial = f"cast(date_diff('day', DATE '1899-12-30', {day}) AS varchar)"
    return (
        f"CASE form WHEN 0 THEN strftime({day}, '%Y-%m-%d') WHEN 1 THEN strftime({day}, '%d.%m.%Y') "
        f"WHEN 2 THEN strftime({day}, '%d/%m/%Y') WHEN 3 THEN {serial} WHEN 4 THEN {serial} || '.0' "
        f"WHEN 5 THEN strftime({day}, '%Y%m%d') ELSE strftime({day}, '%Y-%m-%d') || 'T10:00:00' END"
    )


def month_of(stamp: str) -> str:
    start = f"cast(date_trunc('month', {stamp}) AS date)"
    return f"{start} AS start_date, last_day({start}) AS end_date"


def unit_of(part: str) -> str:
    return f"CASE {part} % 3 WHEN 0 THEN 'шт' WHEN 1 THEN 'кг' ELSE 'м' END"


# --- clean feeds -------------------------------------------------------------------------------

EXPORT_DAY = "end_date + CASE WHEN copy = 1 THEN 17 ELSE 1 END"
COPY_NUMBERS = "(VALUES (0), (1), (2)) AS c(copy)"

BLOCKS["bounds"] = """
  SELECT make_date(min(year(day)), 1, 1) AS first_day, make_date(max(year(day)), 12, 31) AS last_day
  FROM (SELECT l_shipdate AS day FROM lineitem UNION ALL SELECT o_orderdate FROM orders) AS d
"""
_MONTH_LIST = ", ".join(f"'{n}'" for n in MONTH_NAMES)
BLOCKS["calendar_days"] = f"""
  SELECT d AS full_date, year(d) * 10000 + month(d) * 100 + day(d) AS date_key,
         year(d) AS year_num, quarter(d) AS quarter_num, month(d) AS month_num,
         [{_MONTH_LIST}][month(d)] AS month_name,
         day(d) AS day_of_month, isodow(d) AS day_of_week,
         CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT cast(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS date) AS d
        FROM bounds) AS s
"""
BLOCKS["moved"] = f"""
  SELECT l_suppkey, l_partkey, start_date, end_date, sum(q) AS opening,
         coalesce(sum(q) FILTER (WHERE l_returnflag = 'R'), 0) AS income,
         coalesce(sum(q) FILTER (WHERE l_returnflag <> 'R'), 0) AS outgo
  FROM (SELECT l_suppkey, l_partkey, l_returnflag, cast(l_quantity AS decimal(18,3)) AS q,
               {month_of('l_shipdate')} FROM lineitem) AS m
  GROUP BY ALL
"""
BLOCKS["ods_turnover"] = f"""
  SELECT {EXPORT_DAY} AS date, start_date, end_date,
         CASE WHEN copy = 3 THEN '{UNREGISTERED}' ELSE '' END || l_suppkey AS warehouse_code,
         cast(l_partkey + CASE WHEN copy = 2 THEN {UNPRICED} + 1 ELSE 1 END AS integer) AS material_id,
         {unit_of('l_partkey')} AS unit,
         cast(opened AS decimal(18,3)) AS balance_start, cast(income AS decimal(18,3)) AS income_qty,
         cast(-outgo AS decimal(18,3)) AS expense_qty,
         cast(opened + income - outgo AS decimal(18,3)) AS balance_end
  FROM (SELECT *, opening + copy + (l_partkey % 10) * 0.001 AS opened
        FROM moved, (VALUES (0), (1), (2), (3)) AS c(copy)
        WHERE copy = 0 OR (copy = 1 AND (l_suppkey + l_partkey) % 5 = 0)
           OR (copy = 2 AND (l_suppkey + l_partkey) % 13 = 5)
           OR (copy = 3 AND (l_suppkey + l_partkey) % 11 = 3)) AS e
"""
BLOCKS["priced_months"] = f"""
  SELECT l_partkey, start_date, end_date,
         cast(cast(p_retailprice AS decimal(18,2)) + month(start_date) * 0.25 AS decimal(18,2)) AS price,
         l_partkey * 1000 + (year(start_date) - 1990) * 12 + month(start_date) AS mark
  FROM (SELECT DISTINCT l_partkey, {month_of('l_shipdate')} FROM lineitem) AS m
  JOIN part ON p_partkey = l_partkey
"""
BLOCKS["ods_prices"] = f"""
  SELECT {EXPORT_DAY} AS date, start_date, end_date, cast(l_partkey + 1 AS integer) AS material_id,
         cast(price + copy * 2 AS decimal(18,2)) AS price
  FROM priced_months, {COPY_NUMBERS} WHERE copy = 0 OR (copy = 1 AND l_partkey % 7 = 0)
"""
_STEPS = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(SNAPSHOT_DAYS))
BLOCKS["ods_warehouses"] = f"""
  SELECT s_suppkey * 4 + step AS load_id, snapshot_day AS date, snapshot_day AS start_date,
         snapshot_day + 30 AS end_date, cast(s_suppkey AS varchar) AS warehouse_code,
         CASE WHEN s_suppkey % 17 <> 2 THEN n_name END AS shop_code,
         CASE WHEN s_acctbal < 5000 THEN 'MAIN' ELSE 'TRANSIT' END AS warehouse_type,
         CASE WHEN s_suppkey % 6 = 0 AND step >= 2 THEN 'RESERVE' ELSE r_name END AS directorate,
         CASE WHEN s_suppkey % 19 <> 4 THEN s_nationkey + 1
              + CASE WHEN s_suppkey % 3 = 0 THEN step ELSE 0 END END AS mol_id,
         CASE WHEN s_suppkey % 5 = 0 THEN 'keeper' END AS mol_position
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
       (VALUES {_STEPS}) AS d(step, snapshot_day)
"""

# --- raw feeds ---------------------------------------------------------------------------------

BLOCKS["lines_moved"] = f"""
  SELECT *, opening + income + expense AS closing, number % 7 AS form
  FROM (SELECT l_orderkey AS mark, s, p, copy, {month_of('d')},
               number,
               cast(exact * 2 + CASE WHEN copy = 1 THEN 1 ELSE 0 END AS decimal(18,3)) AS opening,
               cast(CASE WHEN f = 'R' THEN exact ELSE 0 END AS decimal(18,3)) AS income,
               cast(CASE WHEN f = 'R' THEN 0 ELSE -exact END AS decimal(18,3)) AS expense
        FROM (SELECT l_orderkey, l_suppkey AS s, l_partkey AS p, l_returnflag AS f, l_shipdate AS d,
                     l_orderkey * {LINES_PER_ORDER} + row_number() OVER (
                       PARTITION BY l_orderkey ORDER BY {", ".join(LINE_COLUMNS)}) AS number,
                     cast(cast(l_quantity AS decimal(18,3)) + (l_orderkey % 1000) * 0.001
                          AS decimal(18,3)) AS exact
              FROM lineitem) AS l, {COPY_NUMBERS}
        WHERE copy = 0 OR (copy = 1 AND l_orderkey % 5 = 0) OR (copy = 2 AND l_orderkey % 7 = 0)
       ) AS m
"""
BLOCKS["raw_turnover"] = f"""
  SELECT number * 4 + copy AS load_id, 'turnover-' || form || '.csv' AS file_name,
         CASE WHEN mark % 101 = 0 THEN 'мусор' ELSE {text_of(f'({EXPORT_DAY})')} END AS date,
         {text_of('(CASE WHEN mark % 131 = 0 THEN end_date ELSE start_date END)')} AS start_date,
         {text_of('(CASE WHEN mark % 131 = 0 THEN start_date ELSE end_date END)')} AS end_date,
         CASE WHEN mark % 107 = 0 THEN '  ' ELSE cast(s AS varchar) END AS warehouse_code,
         CASE WHEN mark % 149 = 0 THEN '0' WHEN mark % 103 = 0 THEN 'x'
              WHEN number % 3 = 1 THEN (p + 1) || '.0' WHEN number % 3 = 2 THEN ' ' || (p + 1) || ' '
              ELSE cast(p + 1 AS varchar) END AS material_id,
         CASE WHEN mark % 109 = 0 THEN '' ELSE {unit_of('p')} END AS unit,
         CASE WHEN mark % 139 = 0 THEN '-5' ELSE cast(opening AS varchar) END AS balance_start,
         CASE WHEN mark % 137 = 0 THEN '1e3' ELSE cast(income AS varchar) END AS income_qty,
         CASE WHEN mark % 127 = 0 THEN '3' ELSE cast(expense AS varchar) END AS expense_qty,
         cast(cast(closing AS decimal(18,3)) + CASE WHEN mark % 151 = 0 THEN 0.001
              WHEN mark % 113 = 0 THEN 0.002 ELSE 0.000 END AS varchar) AS balance_end
  FROM lines_moved
"""
BLOCKS["raw_prices"] = f"""
  SELECT mark * 4 + copy AS load_id, 'prices-' || form || '.csv' AS file_name,
         {text_of(f'({EXPORT_DAY})')} AS date,
         CASE WHEN mark % 101 = 0 THEN '31.02.2024' ELSE {text_of('start_date')} END AS start_date,
         {text_of('end_date')} AS end_date,
         CASE WHEN mark % 103 = 0 THEN '-7' ELSE cast(l_partkey + 1 AS varchar) END AS material_id,
         CASE WHEN mark % 109 = 0 THEN '12,5' WHEN mark % 107 = 0 THEN '0'
              ELSE cast(price + CASE WHEN copy = 1 THEN 2 ELSE 0 END AS decimal(18,2)) || '5'
         END AS price
  FROM (SELECT *, mark % 7 AS form FROM priced_months, {COPY_NUMBERS}
        WHERE copy = 0 OR (copy = 1 AND l_partkey % 7 = 0) OR (copy = 2 AND l_partkey % 9 = 0)) AS x
"""
BLOCKS["raw_warehouses"] = f"""
  SELECT number * 4 + copy AS load_id, 'warehouses-' || form || '.csv' AS file_name,
         {text_of('date')} AS date, {text_of('start_date')} AS start_date,
         {text_of('end_date')} AS end_date,
         CASE WHEN mark % 23 = 0 THEN ' ' ELSE warehouse_code END AS warehouse_code, shop_code,
         CASE WHEN mark % 29 = 0 THEN '' ELSE warehouse_type END AS warehouse_type, directorate,
         CASE WHEN mark % 37 = 0 THEN '-1' WHEN mark % 31 = 0 THEN 'abc'
              ELSE mol_id || '.0' END AS mol_id, mol_position
  FROM (SELECT * EXCLUDE (load_id), load_id AS number, load_id + 1 AS mark, load_id % 7 AS form
        FROM ods_warehouses, {COPY_NUMBERS}
        WHERE copy = 0 OR (copy = 1 AND load_id % 7 = 0)) AS w
"""

COLUMNS = {
    "turnover": ["date", "start_date", "end_date", "warehouse_code", "material_id", "unit",
                 "balance_start", "income_qty", "expense_qty", "balance_end"],
    "prices": ["date", "start_date", "end_date", "material_id", "price"],
    "warehouses": ["date", "start_date", "end_date", "warehouse_code", "shop_code",
                   "warehouse_type", "directorate", "mol_id", "mol_position"],
}
KEYS = {
    "turnover": "date, material_id, warehouse_code, start_date, end_date",
    "prices": "date, material_id, start_date, end_date",
    "warehouses": "date, warehouse_code, start_date, end_date",
}


def _typed(column: str) -> str:
    if column in ("date", "start_date", "end_date"):
        return date_of(column)
    if column in ("material_id", "mol_id"):
        return int_of(column)
    if column in ("balance_start", "income_qty", "expense_qty", "balance_end"):
        return decimal_of(column, 3)
    if column == "price":
        return decimal_of(column, 2)
    return f"nullif(trim({column}), '')"


_DATES = [(f"{c} IS NULL", f"Некорректная {c}") for c in ("date", "start_date", "end_date")]
REASONS = {
    "turnover": [
        *_DATES,
        *[(f"{c} IS NULL", f"Некорректный {c}") for c in
          ("material_id", "balance_start", "income_qty", "expense_qty", "balance_end")],
        *[(f"{c} IS NULL", f"Пустой {c}") for c in ("warehouse_code", "material_id", "unit")],
        *[(c, c) for c in ("start_date > end_date", "material_id <= 0", "income_qty < 0",
                           "expense_qty > 0", "balance_start < 0", "balance_end < 0")],
        ("abs(balance_start + income_qty + expense_qty - balance_end) > 0.001",
         "Несоответствие остатков и движений"),
    ],
    "prices": [
        *_DATES,
        *[(f"{c} IS NULL", f"Некорректный {c}") for c in ("material_id", "price")],
        *[(c, c) for c in ("start_date > end_date", "material_id <= 0", "price <= 0")],
    ],
    "warehouses": [
        *_DATES,
        *[(f"{c} IS NULL", f"Пустой {c}") for c in ("warehouse_code", "warehouse_type")],
        ("mol_id IS NULL AND nullif(trim(raw_mol_id), '') IS NOT NULL", "Некорректный mol_id"),
        *[(c, c) for c in ("mol_id <= 0", "start_date > end_date")],
    ],
}

for _feed, _columns in COLUMNS.items():
    _raw = ", ".join(f"{c} AS raw_{c}" for c in _columns)
    _clean = ", ".join(f"{_typed(c)} AS {c}" for c in _columns)
    BLOCKS[f"clean_{_feed}"] = f"SELECT load_id, file_name, {_raw}, {_clean} FROM raw_{_feed}"
    _texts = ", ".join(f"CASE WHEN {broken} THEN '{text}' END" for broken, text in REASONS[_feed])
    BLOCKS[f"checked_{_feed}"] = (
        f"SELECT *, nullif(concat_ws('; ', {_texts}), '') AS error_reason FROM clean_{_feed}"
    )
    BLOCKS[f"flagged_{_feed}"] = f"""
      SELECT * EXCLUDE (rn, error_reason), CASE WHEN error_reason IS NULL AND rn > 1
             THEN 'Дубликат строки в staging' ELSE error_reason END AS error_reason
      FROM (SELECT *, row_number() OVER (PARTITION BY error_reason IS NULL, {KEYS[_feed]}
                                         ORDER BY load_id) AS rn FROM checked_{_feed}) AS r
    """
    _list = ", ".join(_columns)
    oracle(f"clean_{_feed}", f"SELECT * FROM clean_{_feed}")
    oracle(f"validate_{_feed}", f"SELECT load_id, {_list}, error_reason FROM checked_{_feed}")
    oracle(f"dedup_{_feed}", f"SELECT load_id, error_reason FROM flagged_{_feed}")
    _cells = ", ".join(f"nullif({c}, '') AS {c}" for c in _columns)
    oracle(f"scan_{_feed}", f"SELECT {_cells} FROM raw_{_feed}")

# --- scalar functions --------------------------------------------------------------------------

for _name, _cell, _value in [
    ("parse_date", "date", date_of("date")),
    ("blank_to_null", "warehouse_code", "nullif(trim(warehouse_code), '')"),
    ("to_int", "material_id", int_of("material_id")),
    ("to_qty", "income_qty", decimal_of("income_qty", 3)),
]:
    oracle(_name, f"SELECT load_id, {_cell} AS raw, {_value} AS parsed FROM raw_turnover")
oracle("to_price",
       f"SELECT load_id, price AS raw, {decimal_of('price', 2)} AS parsed FROM raw_prices")

oracle("safe_ratio", f"""
  SELECT l_orderkey, {whole_ratio('num', 'den', 4)} AS share,
         {whole_ratio('num - den', 'den', 4)} AS change
  FROM (SELECT l_orderkey, cast(sum(cast(l_discount AS decimal(18,2))) AS decimal(18,2)) AS num,
               cast(sum(cast(l_tax AS decimal(18,2))) AS decimal(18,2)) AS den
        FROM lineitem GROUP BY l_orderkey) AS s
""")
oracle("dim_date", """
  SELECT date_key, full_date, year_num, quarter_num, month_num, month_name, day_of_month,
         day_of_week, is_weekend, count(o_orderkey) AS n_orders
  FROM calendar_days LEFT JOIN orders ON cast(o_orderdate AS date) = full_date GROUP BY ALL
""")

# --- files -------------------------------------------------------------------------------------

_PRICE_LINE = " || ';' || ".join(COLUMNS["prices"])
oracle("export_delimited", f"""
  SELECT {_PRICE_LINE} AS line, count(*) AS n FROM raw_prices GROUP BY ALL
""")
oracle("scan_quoted", """
  SELECT doc_id, sha256(nullif(text, '')) AS digest, length(nullif(text, '')) AS n_chars FROM documents
""")
oracle("staging_append", """
  SELECT count(*) AS n_rows, count(DISTINCT load_id) AS highest, 0 AS n_without_file,
         1 AS is_in_order FROM raw_turnover
""")
oracle("file_listing", """
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m') || '.csv' AS file_name FROM orders
""")
oracle("stale_outputs", """
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS stem FROM orders WHERE month(o_orderdate) % 5 = 0
""")
BLOCKS["document_prints"] = """
  SELECT doc_id, '/import/' || doc_id || '.csv' AS file_path, octet_length(encode(text)) AS file_size_bytes,
         sha256(octet_length(encode(text)) || '|' || n || '|' || CASE WHEN n = 0 THEN '' ELSE sha256(
           list_aggregate([sha256(x) FOR x IN string_split(text, chr(10))][:n], 'string_agg', '')) END) AS file_hash
  FROM (SELECT doc_id, text, len(string_split(text, chr(10)))
               - CASE WHEN text = '' OR ends_with(text, chr(10)) THEN 1 ELSE 0 END AS n FROM documents) AS d
"""
BLOCKS["bundle_lines"] = f"""
  SELECT bundle, row_number() OVER (PARTITION BY bundle ORDER BY doc_id, place) - 1 AS i, line
  FROM (SELECT doc_id // {BUNDLE} AS bundle, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents) AS l
"""
BLOCKS["bundle_blocks"] = f"""
  SELECT bundle, i // {BUNDLE_LINES} AS block, sha256(string_agg(sha256(line), '' ORDER BY i)) AS digest,
         count(*) AS n, sum(octet_length(encode(line)) + 1) AS bytes
  FROM bundle_lines GROUP BY ALL
"""
oracle("file_fingerprint_large", """
  SELECT bundle, sum(bytes) AS file_size_bytes,
         sha256(sum(bytes) || '|' || sum(n) || '|' || string_agg(digest, '' ORDER BY block)) AS file_hash
  FROM bundle_blocks GROUP BY bundle
""")
BLOCKS["document_registry"] = """
  SELECT 'documents' AS source_type, doc_id || '.csv' AS file_name, file_path,
         CASE WHEN doc_id % 5 = 1 THEN repeat('0', 64) ELSE file_hash END AS file_hash,
         file_size_bytes,
         CASE doc_id % 5 WHEN 2 THEN 'failed' WHEN 3 THEN 'pending' ELSE 'loaded' END AS status,
         1 AS rows_loaded, CASE WHEN doc_id % 5 = 2 THEN 'unreadable' END AS error_message
  FROM document_prints
"""
oracle("file_fingerprint", "SELECT file_path, file_hash, file_size_bytes FROM document_prints")
oracle("file_decision", """
  SELECT file_path, file_hash, file_size_bytes,
         CASE doc_id % 5 WHEN 0 THEN 'NEW' WHEN 4 THEN 'SKIP' ELSE 'RELOAD' END AS decision
  FROM document_prints
""")
oracle("registry_upsert", """
  SELECT 'documents' AS source_type, doc_id || '.csv' AS file_name, file_path, file_hash,
         file_size_bytes, 'loaded' AS status,
         CASE WHEN doc_id % 5 = 4 THEN 1 ELSE 2 END AS rows_loaded,
         cast(NULL AS varchar) AS error_message
  FROM document_prints
""")
oracle("file_status", """
  SELECT source_type, file_path, status, rows_loaded, error_message FROM document_registry
  ORDER BY status <> 'failed', source_type, file_path
""")

# --- routing -----------------------------------------------------------------------------------

_T = ", ".join(COLUMNS["turnover"])
_T_RAW = ", ".join(f"raw_{c} AS {c}" for c in COLUMNS["turnover"])
oracle("error_reason", """
  SELECT load_id, error_reason FROM checked_turnover WHERE error_reason IS NOT NULL
""")
oracle("balance_check", """
  SELECT load_id, cast(gap AS decimal(18,3)) AS gap
  FROM (SELECT load_id, abs(balance_start + income_qty + expense_qty - balance_end) AS gap
        FROM clean_turnover) AS g WHERE gap > 0.001
""")
oracle("flag_duplicates", f"""
  SELECT load_id, {KEYS['turnover']} FROM flagged_turnover
  WHERE error_reason = 'Дубликат строки в staging'
""")
oracle("route_valid", f"SELECT load_id, {_T} FROM flagged_turnover WHERE error_reason IS NULL")
BLOCKS["quarantine_turnover"] = f"""
  SELECT load_id, file_name, error_reason, {_T_RAW} FROM flagged_turnover
  WHERE error_reason IS NOT NULL
"""
oracle("route_quarantine", "SELECT * FROM quarantine_turnover")
oracle("quarantine_new", "SELECT * FROM quarantine_turnover WHERE load_id % 8 >= 4")
oracle("ods_new", f"""
  SELECT load_id, {_T}
  FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS['turnover']}
                                     ORDER BY load_id % 8 >= 4, load_id) AS place
        FROM checked_turnover WHERE error_reason IS NULL) AS r
  WHERE place = 1 AND load_id % 8 >= 4
""")

# --- dimensions --------------------------------------------------------------------------------

BLOCKS["master"] = """
  SELECT material_id, t.unit
  FROM (SELECT DISTINCT ON (material_id) material_id, unit FROM ods_turnover
        ORDER BY material_id, unit DESC NULLS LAST) AS t
  FULL JOIN (SELECT DISTINCT material_id FROM ods_prices) AS p USING (material_id)
"""
oracle("material_master", "SELECT * FROM master")
oracle("scd1_material", """
  SELECT coalesce(m.material_id, s.material_id) AS material_id,
         CASE WHEN m.unit IS NOT NULL THEN m.unit ELSE s.unit END AS unit
  FROM master AS m
  FULL JOIN (SELECT p_partkey + 1 AS material_id,
                    CASE p_partkey % 5 WHEN 1 THEN 'т' WHEN 2 THEN 'шт' END AS unit
             FROM part WHERE p_partkey % 5 <> 0) AS s ON s.material_id = m.material_id
""")


def _changes(snapshots: str) -> str:
    return f"""
      SELECT * EXCLUDE (state, before, place)
      FROM (SELECT *, lag(state) OVER w AS before, row_number() OVER w AS place
            FROM (SELECT *, coalesce(shop_code, '') || '|' || coalesce(warehouse_type, '') || '|'
                         || coalesce(directorate, '') || '|' || coalesce(mol_id, -1) || '|'
                         || coalesce(mol_position, '') AS state FROM {snapshots}) AS s
            WINDOW w AS (PARTITION BY warehouse_code ORDER BY snapshot_date)) AS c
      WHERE place = 1 OR state <> before
    """


def _versions(changed: str) -> str:
    return f"""
      SELECT warehouse_code, shop_code, warehouse_type, directorate, mol_id, mol_position,
             snapshot_date AS date_from, coalesce(following - 1, DATE '9999-12-31') AS date_to,
             CASE WHEN following IS NULL THEN 1 ELSE 0 END AS is_current
      FROM (SELECT *, lead(snapshot_date) OVER (PARTITION BY warehouse_code
                                                ORDER BY snapshot_date) AS following
            FROM {changed}) AS c
    """


def _days(rows: str) -> str:
    return f"""
      SELECT * EXCLUDE (place, date, load_id, start_date, end_date), date AS snapshot_date
      FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_code, date ORDER BY load_id) AS place
            FROM {rows}) AS r WHERE place = 1
    """


BLOCKS["registry_days"] = _days("ods_warehouses")
BLOCKS["registry_changes"] = _changes("registry_days")
BLOCKS["registered"] = _versions("registry_changes")
oracle("scd2_build", "SELECT * FROM registered")
BLOCKS["unknown"] = """
  SELECT DISTINCT warehouse_code, '—' AS shop_code, 'UNKNOWN' AS warehouse_type,
         'Не определена' AS directorate, cast(NULL AS integer) AS mol_id,
         cast(NULL AS varchar) AS mol_position, DATE '1900-01-01' AS date_from,
         DATE '9999-12-31' AS date_to, 1 AS is_current
  FROM ods_turnover WHERE warehouse_code NOT IN (SELECT warehouse_code FROM registered)
"""
oracle("unknown_members", "SELECT * FROM unknown")
BLOCKS["versions"] = "SELECT * FROM registered UNION ALL SELECT * FROM unknown"

BLOCKS["event_days"] = """
  SELECT warehouse_code, shop_code, 'MAIN' AS warehouse_type, cast(NULL AS varchar) AS directorate,
         cast(NULL AS integer) AS mol_id, cast(NULL AS varchar) AS mol_position, snapshot_date
  FROM (SELECT cast(user_id AS varchar) AS warehouse_code, event_type AS shop_code,
               cast(ts AS date) AS snapshot_date,
               row_number() OVER (PARTITION BY user_id, cast(ts AS date) ORDER BY event_id) AS place
        FROM events) AS e WHERE place = 1
"""
BLOCKS["event_changes"] = _changes("event_days")
BLOCKS["early_days"] = f"SELECT * FROM event_days WHERE snapshot_date <= DATE '{LOADED_UNTIL}'"
BLOCKS["early_changes"] = _changes("early_days")
BLOCKS["early_versions"] = _versions("early_changes")
BLOCKS["pending"] = """
  SELECT c.warehouse_code, c.snapshot_date, c.shop_code
  FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_code ORDER BY snapshot_date DESC) AS place
        FROM event_changes) AS c
  JOIN early_versions AS v ON v.warehouse_code = c.warehouse_code AND v.is_current = 1
  WHERE c.place = 1 AND c.snapshot_date > v.date_from
    AND coalesce(c.shop_code, '') <> coalesce(v.shop_code, '')
"""
oracle("warehouse_snapshots", "SELECT warehouse_code, snapshot_date, shop_code FROM event_days")
oracle("warehouse_changes", "SELECT warehouse_code, snapshot_date, shop_code FROM event_changes")
oracle("scd2_increment", "SELECT * FROM pending")
oracle("scd2_close", """
  SELECT v.warehouse_code, v.shop_code, v.date_from,
         CASE WHEN p.warehouse_code IS NOT NULL AND v.is_current = 1
              THEN p.snapshot_date - 1 ELSE v.date_to END AS date_to,
         CASE WHEN p.warehouse_code IS NOT NULL THEN 0 ELSE v.is_current END AS is_current
  FROM early_versions AS v LEFT JOIN pending AS p ON p.warehouse_code = v.warehouse_code
""")
oracle("scd2_open", """
  SELECT warehouse_code, shop_code, snapshot_date AS date_from, DATE '9999-12-31' AS date_to,
         1 AS is_current FROM pending
""")

# --- facts -------------------------------------------------------------------------------------

BLOCKS["last_turnover"] = """
  SELECT * EXCLUDE (place)
  FROM (SELECT *, row_number() OVER (PARTITION BY start_date, end_date, warehouse_code, material_id
                                     ORDER BY date DESC) AS place FROM ods_turnover) AS t
  WHERE place = 1
"""
BLOCKS["last_prices"] = """
  SELECT * EXCLUDE (place)
  FROM (SELECT *, row_number() OVER (PARTITION BY start_date, end_date, material_id
                                     ORDER BY date DESC) AS place FROM ods_prices) AS t
  WHERE place = 1
"""
oracle("latest_turnover", """
  SELECT start_date, end_date, warehouse_code, material_id, date, balance_start, income_qty,
         expense_qty, balance_end FROM last_turnover
""")
oracle("latest_prices", "SELECT start_date, end_date, material_id, date, price FROM last_prices")
oracle("date_keys", """
  SELECT t.warehouse_code, t.material_id, t.date, s.date_key AS date_key_start,
         e.date_key AS date_key_end
  FROM ods_turnover AS t JOIN calendar_days AS s ON s.full_date = t.start_date
  JOIN calendar_days AS e ON e.full_date = t.end_date
""")
oracle("material_key", """
  SELECT material_id, count(*) AS n_rows, 1 AS n_keys FROM ods_turnover
  WHERE material_id IN (SELECT material_id FROM ods_prices) GROUP BY material_id
""")
oracle("scd2_asof", """
  SELECT t.warehouse_code, t.material_id, t.start_date, t.date, v.date_from
  FROM ods_turnover AS t LEFT JOIN registered AS v
    ON v.warehouse_code = t.warehouse_code AND t.date >= v.date_from AND t.date <= v.date_to
""")


# First the version that began last on each distinct export day, then the rows.
BLOCKS["covering"] = """
  SELECT q.warehouse_code, q.date, coalesce(v.date_from, cur.date_from) AS date_from
  FROM (SELECT DISTINCT warehouse_code, date FROM ods_turnover) AS q
  ASOF LEFT JOIN versions AS v ON v.warehouse_code = q.warehouse_code AND v.date_from <= q.date
  LEFT JOIN versions AS cur ON cur.warehouse_code = q.warehouse_code AND cur.is_current = 1
"""


def _resolved(rows: str) -> str:
    return f"SELECT t.*, c.date_from FROM {rows} AS t LEFT JOIN covering AS c USING (warehouse_code, date)"


BLOCKS["resolved_all"] = _resolved("ods_turnover")
oracle("scd2_fallback",
       "SELECT warehouse_code, material_id, start_date, date, date_from FROM resolved_all")


def _facts(rows: str) -> str:
    return f"""
      SELECT s.date_key AS date_key_start, e.date_key AS date_key_end, warehouse_code, date_from,
             material_id, cast(balance_start AS decimal(18,2)) AS balance_start,
             cast(income_qty AS decimal(18,2)) AS income_qty,
             cast(expense_qty AS decimal(18,2)) AS expense_qty,
             cast(balance_end AS decimal(18,2)) AS balance_end
      FROM {rows} AS t JOIN calendar_days AS s ON s.full_date = t.start_date
      JOIN calendar_days AS e ON e.full_date = t.end_date
    """


BLOCKS["resolved_last"] = _resolved("last_turnover")
BLOCKS["fact_inventory"] = _facts("resolved_last")
BLOCKS["fact_prices"] = """
  SELECT s.date_key AS date_key_start, e.date_key AS date_key_end, material_id, price
  FROM last_prices AS p JOIN calendar_days AS s ON s.full_date = p.start_date
  JOIN calendar_days AS e ON e.full_date = p.end_date
"""
_SEEN = "date = end_date + 1 AND year(start_date) < (SELECT year(last_day) FROM bounds)"
BLOCKS["seen_turnover"] = f"SELECT * FROM ods_turnover WHERE {_SEEN}"
BLOCKS["resolved_seen"] = _resolved("seen_turnover")
BLOCKS["stored_inventory"] = _facts("resolved_seen")
_INVENTORY_KEY = "date_key_start, date_key_end, warehouse_code, date_from, material_id"
_QUANTITIES = ["balance_start", "income_qty", "expense_qty", "balance_end"]
_CHANGED = " OR ".join(f"coalesce(o.{q}, 0) <> coalesce(n.{q}, 0)" for q in _QUANTITIES)
BLOCKS["upserted"] = f"""
  SELECT n.*, CASE WHEN o.material_id IS NULL THEN 'insert' WHEN {_CHANGED} THEN 'update'
                   ELSE 'keep' END AS action
  FROM fact_inventory AS n LEFT JOIN stored_inventory AS o USING ({_INVENTORY_KEY})
  UNION ALL
  SELECT o.*, 'keep' AS action FROM stored_inventory AS o ANTI JOIN fact_inventory AS n
    USING ({_INVENTORY_KEY})
"""
oracle("upsert_inventory", "SELECT * FROM upserted")
oracle("upsert_prices", f"""
  SELECT n.*, CASE WHEN o.price IS NULL THEN 'insert' WHEN o.price <> n.price THEN 'update'
                   ELSE 'keep' END AS action
  FROM fact_prices AS n LEFT JOIN
    (SELECT year(start_date) * 10000 + month(start_date) * 100 + day(start_date) AS date_key_start,
            year(end_date) * 10000 + month(end_date) * 100 + day(end_date) AS date_key_end,
            material_id, price FROM ods_prices WHERE {_SEEN}) AS o
    USING (date_key_start, date_key_end, material_id)
""")
oracle("price_lookup", f"""
  SELECT {_INVENTORY_KEY}, balance_end, price
  FROM fact_inventory LEFT JOIN fact_prices USING (date_key_start, date_key_end, material_id)
""")
BLOCKS["both_loads"] = "SELECT * EXCLUDE (action) FROM upserted"
BLOCKS["star"] = """
  SELECT f.date_key_start, f.date_key_end, d.year_num, d.month_num, f.warehouse_code,
         coalesce(v.directorate, 'Не определена') AS directorate,
         coalesce(v.shop_code, '—') AS shop_code,
         coalesce(v.warehouse_type, 'UNKNOWN') AS warehouse_type, f.material_id, m.unit,
         f.balance_start, f.income_qty, f.expense_qty, f.balance_end
  FROM fact_inventory AS f JOIN calendar_days AS d ON d.date_key = f.date_key_start
  JOIN master AS m ON m.material_id = f.material_id
  JOIN versions AS v ON v.warehouse_code = f.warehouse_code AND v.date_from = f.date_from
"""
oracle("star_join", "SELECT * FROM star")

# --- marts -------------------------------------------------------------------------------------

BLOCKS["monthly_sums"] = """
  SELECT year_num * 100 + month_num AS month_key, year_num, month_num, warehouse_code,
         max(directorate) AS directorate, max(shop_code) AS shop_code,
         max(warehouse_type) AS warehouse_type, material_id, unit,
         cast(sum(balance_start) AS decimal(18,2)) AS balance_start,
         cast(sum(income_qty) AS decimal(18,2)) AS income_qty,
         cast(sum(expense_qty) AS decimal(18,2)) AS expense_qty,
         cast(sum(balance_end) AS decimal(18,2)) AS balance_end,
         cast(sum(abs(expense_qty)) AS decimal(18,2)) AS consumed, max(price) AS price
  FROM star LEFT JOIN fact_prices USING (date_key_start, date_key_end, material_id)
  GROUP BY year_num, month_num, warehouse_code, material_id, unit
"""
BLOCKS["monthly"] = """
  SELECT * EXCLUDE (consumed), cast(balance_end * price AS decimal(18,2)) AS stock_value,
         cast(avg_qty * price AS decimal(18,2)) AS avg_stock_value,
         cast(consumed * price AS decimal(18,2)) AS expense_value
  FROM (SELECT *, cast((balance_start + balance_end) * 0.5 AS decimal(18,2)) AS avg_qty
        FROM monthly_sums) AS m
"""
oracle("inventory_monthly", "SELECT * FROM monthly")
oracle("vw_inventory_monthly", "SELECT * FROM monthly")

_SUMS = ", ".join(
    f"cast(sum({m}) AS decimal(18,2)) AS {m}"
    for m in ("stock_value", "avg_stock_value", "expense_value")
)
# Every row of the mart offers itself to all slices it belongs to; slices are then summed at once.
BLOCKS["offered"] = """
  SELECT *, unnest([{'lv': 'company', 'k': 'ALL'}, {'lv': 'directorate', 'k': directorate},
                    {'lv': 'shop', 'k': directorate || ' | ' || shop_code},
                    {'lv': 'warehouse', 'k': warehouse_code}]) AS slice
  FROM monthly
"""
BLOCKS["level_sums"] = f"""
  SELECT month_key, year_num, month_num, slice.lv AS agg_level, slice.k AS agg_key,
         max(directorate) FILTER (WHERE slice.lv <> 'company') AS directorate,
         max(shop_code) FILTER (WHERE slice.lv IN ('shop', 'warehouse')) AS shop_code,
         max(warehouse_code) FILTER (WHERE slice.lv = 'warehouse') AS warehouse_code,
         max(warehouse_type) FILTER (WHERE slice.lv = 'warehouse') AS warehouse_type, {_SUMS}
  FROM offered
  WHERE NOT (slice.lv = 'directorate' AND directorate = '') AND NOT (slice.lv = 'shop' AND shop_code = '')
  GROUP BY ALL
"""
BLOCKS["metrics_now"] = f"""
  SELECT l.*, d.month_name,
         {whole_ratio('expense_value', 'avg_stock_value', 4)} AS turnover_ratio,
         {whole_ratio('30 * avg_stock_value', 'expense_value', 2)} AS turnover_days
  FROM level_sums AS l JOIN calendar_days AS d
    ON d.year_num = l.year_num AND d.month_num = l.month_num AND d.day_of_month = 1
"""


def _mom(measure: str, scale: int) -> str:
    value = whole_ratio(f"m.{measure} - b.{measure}", f"b.{measure}", 4, scale)
    return f"{value} AS mom_{measure}"


BLOCKS["metrics"] = f"""
  SELECT m.*, {_mom('stock_value', 2)}, {_mom('avg_stock_value', 2)}, {_mom('turnover_ratio', 4)},
         {_mom('turnover_days', 2)}
  FROM metrics_now AS m LEFT JOIN metrics_now AS b
    ON b.agg_level = m.agg_level AND b.agg_key = m.agg_key
   AND make_date(b.year_num, b.month_num, 1) = make_date(m.year_num, m.month_num, 1) - INTERVAL 1 MONTH
"""
oracle("turnover_metrics", "SELECT * FROM metrics")
# The same blocks over the facts that two loads leave: both versions of a period stay.
_MART = ["star", "monthly_sums", "monthly", "offered", "level_sums", "metrics_now", "metrics"]
for _block in _MART:
    _sql = BLOCKS[_block].replace("fact_inventory", "both_loads")
    BLOCKS[f"two_{_block}"] = re.sub(rf"\b({'|'.join(_MART)})\b", r"two_\1", _sql)
MATERIALIZED |= {"two_monthly", "two_metrics_now"}
oracle("nightly_two_loads", "SELECT * FROM two_metrics")
oracle("stream_load", "SELECT * FROM metrics")
oracle("nightly_counts", """
  SELECT 'ods' AS layer, 'turnover' AS feed, count(*) AS n_rows FROM ods_turnover
  UNION ALL SELECT 'ods', 'prices', count(*) FROM ods_prices
  UNION ALL SELECT 'ods', 'warehouses', count(*) FROM ods_warehouses
  UNION ALL SELECT 'dwh', 'dim_material', count(*) FROM master
  UNION ALL SELECT 'dwh', 'dim_warehouse', count(*) FROM versions
  UNION ALL SELECT 'dwh', 'fact_inventory', count(*) FROM both_loads
  UNION ALL SELECT 'dwh', 'fact_prices', count(*) FROM fact_prices
  UNION ALL SELECT 'datamart', 'inventory_monthly', count(*) FROM two_monthly
  UNION ALL SELECT 'datamart', 'turnover_metrics', count(*) FROM two_metrics
""")
oracle("vw_turnover_metrics", "SELECT * FROM metrics")
for _level in ("company", "directorate", "shop", "warehouse"):
    oracle(f"metrics_{_level}", f"SELECT * FROM metrics WHERE agg_level = '{_level}'")
oracle("mom", """
  SELECT month_key, agg_level, agg_key, mom_stock_value, mom_avg_stock_value, mom_turnover_ratio,
         mom_turnover_days FROM metrics
""")
oracle("vw_warehouse_hierarchy", """
  SELECT DISTINCT warehouse_code, directorate, shop_code, warehouse_type FROM metrics
  WHERE agg_level = 'warehouse'
""")
oracle("top_metrics", "SELECT * FROM metrics ORDER BY agg_level, month_key, agg_key LIMIT 20")
oracle("company_stock_series", """
  SELECT month_key, stock_value FROM metrics WHERE agg_level = 'company' ORDER BY month_key
""")
oracle("role_slice", """
  SELECT reader, month_key, agg_level, agg_key, stock_value, turnover_ratio
  FROM (SELECT 'director ' || r_name AS reader, 'directorate' AS lv, r_name AS zone FROM region
        UNION ALL SELECT 'shop head ' || n_name, 'shop', n_name FROM nation
        UNION ALL SELECT 'keeper ' || s_suppkey, 'warehouse', cast(s_suppkey AS varchar) FROM supplier
        UNION ALL SELECT 'chief', 'warehouse', NULL) AS r
  JOIN metrics AS m ON m.agg_level = r.lv AND (r.zone IS NULL OR r.zone = CASE r.lv
       WHEN 'directorate' THEN m.directorate WHEN 'shop' THEN m.shop_code
       ELSE m.warehouse_code END)
""")

BLOCKS["role_rows"] = """
  SELECT role, month_key, agg_level, agg_key, stock_value, mom_stock_value
  FROM metrics JOIN (VALUES ('general_director', 'company', NULL),
    ('production_director', 'directorate', ['ASIA', 'EUROPE']),
    ('purchasing_director', 'directorate', ['AFRICA']),
    ('purchasing_manager', 'directorate', ['AMERICA', 'MIDDLE EAST']),
    ('shop_head', 'shop', ['FRANCE', 'CHINA']),
    ('warehouse_head', 'warehouse', ['1', '2', '3'])) AS r(role, lv, zones)
  ON agg_level = lv AND (zones IS NULL OR list_contains(zones, CASE lv
     WHEN 'directorate' THEN directorate WHEN 'shop' THEN shop_code ELSE warehouse_code END))
"""
oracle("role_views", "SELECT * FROM role_rows")
oracle("role_views_clustered", "SELECT * FROM role_rows")

# --- checks and reports ------------------------------------------------------------------------

oracle("check_unique", f"""
  SELECT {KEYS['turnover']}, count(*) AS n_rows FROM checked_turnover WHERE error_reason IS NULL
  GROUP BY {KEYS['turnover']} HAVING count(*) > 1
""")
oracle("check_fk", """
  SELECT warehouse_code, count(*) AS n_rows FROM ods_turnover
  WHERE warehouse_code NOT IN (SELECT warehouse_code FROM registered) GROUP BY warehouse_code
""")
BLOCKS["faulty"] = """
  SELECT warehouse_code, date_from,
         CASE WHEN code % 7 = 0 AND is_current = 0 THEN date_to + 1
              WHEN code % 11 = 0 AND is_current = 0 THEN date_from - 1 ELSE date_to END AS date_to,
         CASE WHEN code % 13 = 0 THEN 1 ELSE is_current END AS is_current
  FROM (SELECT *, cast(warehouse_code AS integer) AS code FROM early_versions) AS e
"""
_INV = "date_key_start, date_key_end, warehouse_code, date_from, material_id"
BLOCKS["short_days"] = f"SELECT date_key FROM calendar_days, bounds WHERE full_date <= last_day - {CUT_DAYS}"
BLOCKS["facts_twice"] = """
  SELECT * FROM fact_inventory UNION ALL SELECT * FROM fact_inventory WHERE material_id % 7 = 0
"""
oracle("check_constraints", f"""
  SELECT 'unique inventory' AS check_name, cast(coalesce(sum(n), 0) AS bigint) AS n_rows
  FROM (SELECT count(*) AS n FROM facts_twice GROUP BY {_INV} HAVING count(*) > 1) AS t
  UNION ALL SELECT 'unique ' || unnest(['prices', 'materials', 'days', 'versions']), 0
  UNION ALL SELECT 'inventory date_key_start', count(*) FROM facts_twice
            WHERE date_key_start NOT IN (SELECT date_key FROM short_days)
  UNION ALL SELECT 'inventory date_key_end', count(*) FROM facts_twice
            WHERE date_key_end NOT IN (SELECT date_key FROM short_days)
  UNION ALL SELECT 'inventory warehouse_sk', count(*) FROM facts_twice ANTI JOIN registered
            USING (warehouse_code, date_from)
  UNION ALL SELECT 'inventory material_sk', count(*) FROM facts_twice WHERE material_id % 13 = 6
  UNION ALL SELECT 'prices date_key_start', count(*) FROM fact_prices
            WHERE date_key_start NOT IN (SELECT date_key FROM short_days)
  UNION ALL SELECT 'prices date_key_end', count(*) FROM fact_prices
            WHERE date_key_end NOT IN (SELECT date_key FROM short_days)
  UNION ALL SELECT 'prices material_sk', count(*) FROM fact_prices WHERE material_id % 13 = 6
""")
oracle("check_scd2", """
  SELECT warehouse_code, date_from, date_to, is_current, problem
  FROM (SELECT *, concat_ws('; ', CASE WHEN date_from > date_to THEN 'reversed' END,
                 CASE WHEN (is_current = 1) <> (date_to = DATE '9999-12-31') THEN 'current flag' END,
                 CASE WHEN sum(is_current) OVER (PARTITION BY warehouse_code) > 1
                      THEN 'several current' END,
                 CASE WHEN EXISTS (SELECT 1 FROM faulty AS o WHERE o.warehouse_code = b.warehouse_code
                                   AND (o.date_from, o.date_to) < (b.date_from, b.date_to)
                                   AND o.date_to >= b.date_from)
                      THEN 'overlap' END) AS problem
        FROM faulty AS b) AS p
  WHERE problem <> ''
""")
oracle("layer_counts", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{feed}' AS feed, count(*) AS n_rows FROM {block}_{feed} {where}"
    for feed in COLUMNS
    for layer, block, where in (
        ("staging", "raw", ""), ("ods", "flagged", "WHERE error_reason IS NULL"),
        ("quarantine", "flagged", "WHERE error_reason IS NOT NULL"),
    )
) + """
  UNION ALL SELECT 'dwh', 'inventory', count(*) FROM fact_inventory
  UNION ALL SELECT 'dwh', 'prices', count(*) FROM fact_prices
  UNION ALL SELECT 'datamart', 'monthly', count(*) FROM monthly
  UNION ALL SELECT 'skipped', 'documents', count(*) FROM document_prints WHERE doc_id % 5 = 4
""")
oracle("quarantine_reasons", """
  SELECT reason, count(*) AS n_rows
  FROM (SELECT unnest(string_split(error_reason, '; ')) AS reason FROM quarantine_turnover) AS r
  GROUP BY reason
""")
oracle("unknown_share", f"""
  SELECT (SELECT count(*) FROM unknown) AS unknown_codes, unknown_rows, all_rows,
         {whole_ratio('unknown_rows * 100', 'all_rows', 2)} AS unknown_percent
  FROM (SELECT count(*) FILTER (WHERE warehouse_code IN (SELECT warehouse_code FROM unknown))
                 AS unknown_rows, count(*) AS all_rows FROM ods_turnover) AS t
""")
oracle("lost_rows", f"""
  SELECT 'calendar' AS lookup, count(*) AS n_rows FROM ods_turnover, bounds
  WHERE greatest(start_date, end_date) > last_day - {CUT_DAYS}
  UNION ALL
  SELECT 'material', count(*) FROM ods_turnover
  WHERE material_id NOT IN (SELECT material_id FROM ods_prices)
""")
oracle("version_overlap", """
  SELECT date_key_start, date_key_end, warehouse_code, material_id,
         count(DISTINCT date_from) AS n_versions
  FROM upserted GROUP BY date_key_start, date_key_end, warehouse_code, material_id
  HAVING count(DISTINCT date_from) > 1
""")
