"""Monthly marts and the read views on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_key, previous_month_key, safe_ratio
from ..operators.facts import INVENTORY_KEYS, PRICE_KEYS
from ..operators.warehouse import UNKNOWN_DIRECTORATE, UNKNOWN_SHOP, UNKNOWN_TYPE
from ..schemas import MONEY, QUANTITIES
from ..sources.clustered import ROWS_PER_FILE, Clustered, read_slice, write_clustered

# Columns of the two marts as their readers know them.
MONTHLY_COLUMNS = [
    "month_key", "year_num", "month_num", "warehouse_code", "directorate", "shop_code",
    "warehouse_type", "material_id", "unit", "balance_start", "income_qty", "expense_qty",
    "balance_end", "avg_qty", "price", "stock_value", "avg_stock_value", "expense_value",
]
METRIC_COLUMNS = [
    "month_key", "year_num", "month_num", "month_name", "agg_level", "agg_key", "directorate",
    "shop_code", "warehouse_code", "warehouse_type", "stock_value", "avg_stock_value",
    "expense_value", "turnover_ratio", "turnover_days", "mom_stock_value",
    "mom_avg_stock_value", "mom_turnover_ratio", "mom_turnover_days",
]
MONTH = ["month_key", "year_num", "month_num"]
SUMS = ["stock_value", "avg_stock_value", "expense_value"]
COMPARED = ["stock_value", "avg_stock_value", "turnover_ratio", "turnover_days"]

# Level names, key of the whole company, separator of the shop key.
COMPANY, DIRECTORATE, SHOP, WAREHOUSE = "company", "directorate", "shop", "warehouse"
LEVELS = [COMPANY, DIRECTORATE, SHOP, WAREHOUSE]
COMPANY_KEY = "ALL"
KEY_SEPARATOR = " | "


def with_price(facts: DataFrame, prices: DataFrame) -> DataFrame:
    """Price of the same material and period; null where none was delivered.

    One price meets at most one fact per warehouse version, so no key here can run hot.
    """
    return facts.join(prices.select(*PRICE_KEYS, "price"), PRICE_KEYS, "left")


def with_month(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Year and month of the period start."""
    days = calendar.selectExpr("date_key AS date_key_start", "year_num", "month_num")
    return facts.join(F.broadcast(days), "date_key_start")  # one row per day


def with_month_price(dated: DataFrame, prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same as ``with_price`` for facts with year and month, in partitions by month and material.

    Sums by month, warehouse and material need no other shuffle then. The period is compared as a difference:
    as an equality it would become part of the partitioning, and facts of one month be torn apart again.
    """
    by = ["year_num", "month_num", "material_sk"]
    known = with_month(prices.select(*PRICE_KEYS, "price"), calendar).selectExpr(
        *[f"{c} AS _{c}" for c in [*by, "date_key_start", "date_key_end"]], "price"
    )
    same = [f"{c} = _{c}" for c in by] + [f"{c} - _{c} = 0" for c in ("date_key_start", "date_key_end")]
    return dated.join(known, F.expr(" AND ".join(same)), "left").select(*dated.columns, "price")


def labelled(versions: DataFrame) -> DataFrame:
    """Versions with their attributes, unknown ones labelled."""
    return versions.selectExpr(
        "warehouse_sk",
        "warehouse_code",
        f"coalesce(directorate, '{UNKNOWN_DIRECTORATE}') AS directorate",
        f"coalesce(shop_code, '{UNKNOWN_SHOP}') AS shop_code",
        f"coalesce(warehouse_type, '{UNKNOWN_TYPE}') AS warehouse_type",
    )


def with_warehouse(facts: DataFrame, versions: DataFrame) -> DataFrame:
    """Attributes of the fact's warehouse version.

    A large dimension is joined by its key; adaptive execution splits the partition of a hot one.
    """
    return facts.join(labelled(versions), "warehouse_sk")


ATTRIBUTES = ["directorate", "shop_code", "warehouse_type"]


def attribute_lists(versions: DataFrame) -> DataFrame:
    """One row per warehouse: the values each attribute ever had, in order."""
    return labelled(versions).groupBy("warehouse_code").agg(
        *[F.sort_array(F.collect_set(a)).alias(f"{a}_list") for a in ATTRIBUTES]
    )


def with_attribute_places(facts: DataFrame, versions: DataFrame, lists: DataFrame) -> DataFrame:
    """The fact's warehouse, and each attribute as its place in the warehouse's list.

    The greatest place is the greatest value, and a maximum of numbers needs no sort.
    """
    placed = labelled(versions).join(lists, "warehouse_code").selectExpr(
        "warehouse_sk", "warehouse_code",
        *[f"int(array_position({a}_list, {a})) AS {a}_place" for a in ATTRIBUTES],
    )
    return facts.join(placed, "warehouse_sk")


def with_material(rows: DataFrame, materials: DataFrame) -> DataFrame:
    return rows.join(materials.select("material_sk", "material_id", "unit"), "material_sk")


def star_rows(
    facts: DataFrame, calendar: DataFrame, materials: DataFrame, versions: DataFrame
) -> DataFrame:
    """Facts with the attributes of all three dimensions."""
    return with_material(with_warehouse(with_month(facts, calendar), versions), materials)


# --- the detail mart, whole or by changes ----------------------------------------------------------

# Group of the detail mart, what it sums up, and what it takes the greatest of.
MONTHLY_GROUP = ["year_num", "month_num", "warehouse_code", "material_sk"]
ADDED_UP = ["n_facts", *QUANTITIES, "consumed"]
GREATEST = [*[f"{a}_place" for a in ATTRIBUTES], "price"]
# The stored mart also holds what its next change needs.
STATE_COLUMNS = [*MONTHLY_COLUMNS, "material_sk", "n_facts", "consumed"]
STATE_SCHEMA = (
    "month_key int, year_num int, month_num int, warehouse_code string, directorate string, shop_code string, "
    f"warehouse_type string, material_id int, unit string, balance_start {MONEY}, income_qty {MONEY}, "
    f"expense_qty {MONEY}, balance_end {MONEY}, avg_qty {MONEY}, price {MONEY}, stock_value {MONEY}, "
    f"avg_stock_value {MONEY}, expense_value {MONEY}, material_sk long, n_facts long, consumed {MONEY}"
)
EFFECT_SUMS = [
    "cast(sum(n_facts) AS long) AS n_facts",
    *[f"cast(sum({c}) AS {MONEY}) AS {c}" for c in ADDED_UP[1:]],
]


def fact_effects(facts: DataFrame) -> DataFrame:
    """What whole facts add to their group."""
    return facts.selectExpr(
        *INVENTORY_KEYS, "1L AS n_facts", *QUANTITIES, f"cast(abs(expense_qty) AS {MONEY}) AS consumed"
    )


# Marks effects of groups whose greatest price is looked up again.
REPRICED = "_repriced"


def change_effects(changes: DataFrame) -> DataFrame:
    """What changed facts (``old`` and ``new`` measures) add to their group: the new less the old."""

    def gap(value: str) -> str:
        measure = value.format("old"), value.format("new")
        return f"cast(coalesce({measure[1]}, 0) - coalesce({measure[0]}, 0) AS {MONEY})"

    return changes.selectExpr(
        *INVENTORY_KEYS, "if(old IS NULL, 1L, 0L) AS n_facts",
        *[f"{gap('{}.' + q)} AS {q}" for q in QUANTITIES], f"{gap('abs({}.expense_qty)')} AS consumed",
        f"false AS {REPRICED}",
    )


def present_effects(facts: DataFrame) -> DataFrame:
    """Facts that add nothing, but whose attributes and prices count for the greatest ones.

    They may come more than once.
    """
    nothing = [f"cast(0 AS {MONEY}) AS {c}" for c in ADDED_UP[1:]]
    return facts.selectExpr(*INVENTORY_KEYS, "0L AS n_facts", *nothing, f"true AS {REPRICED}")


def _grouped(
    effects: DataFrame, prices: DataFrame, calendar: DataFrame, versions: DataFrame, lists: DataFrame, *marks: str
) -> DataFrame:
    # The warehouse comes first: its join must not undo the partitions by month and material.
    located = with_attribute_places(with_month(effects, calendar), versions, lists)
    return with_month_price(located, prices, calendar).groupBy(*MONTHLY_GROUP).agg(
        *[F.expr(e) for e in EFFECT_SUMS], *[F.max(a).alias(a) for a in (*GREATEST, *marks)]
    )


def _valued(summed: DataFrame, lists: DataFrame, materials: DataFrame, *marks: str) -> DataFrame:
    """Rows of the stored mart from the sums and greatest values of their groups."""
    averaged = summed.selectExpr(
        "*", f"cast((balance_start + balance_end) * 0.5 AS {MONEY}) AS avg_qty"
    )
    valued = averaged.selectExpr(
        "*",
        f"{month_key('year_num', 'month_num')} AS month_key",
        f"cast(balance_end * price AS {MONEY}) AS stock_value",
        f"cast(avg_qty * price AS {MONEY}) AS avg_stock_value",
        f"cast(consumed * price AS {MONEY}) AS expense_value",
    )
    known = with_material(valued, materials)
    # The warehouse comes last: sums by warehouse find its rows together then, and text is not moved.
    named = known.join(lists, "warehouse_code").selectExpr(
        *known.columns, *[f"{a}_list[{a}_place - 1] AS {a}" for a in ATTRIBUTES]
    )
    return named.select(*STATE_COLUMNS, *marks)


def inventory_monthly(
    facts: DataFrame, prices: DataFrame, calendar: DataFrame, materials: DataFrame,
    versions: DataFrame,
) -> DataFrame:
    """One row per month, warehouse and material.

    A generated key stands for one material, so the sums are formed before the material's
    attributes are looked up.
    """
    lists = attribute_lists(versions)
    summed = _grouped(fact_effects(facts), prices, calendar, versions, lists)
    return _valued(summed, lists, materials).select(*MONTHLY_COLUMNS)


def added_monthly(effects: DataFrame, prices: DataFrame, calendar: DataFrame, versions: DataFrame) -> DataFrame:
    """What changes add to each group of the detail mart, with the greatest values among them.

    ``effects`` says what is added to which fact's group. A price may be replaced by a lower one: groups with an
    effect marked as repriced forget theirs, and the effects must hold all their facts.
    """
    return _grouped(effects, prices, calendar, versions, attribute_lists(versions), REPRICED)


def changed_monthly(
    added: DataFrame, stored: DataFrame | None, materials: DataFrame, versions: DataFrame
) -> DataFrame:
    """New rows of the groups that changed, with ``_was_stored``; other groups are not looked at.

    ``stored`` holds the stored rows of all groups that may change, also of those that only get a new unit; None
    where nothing is stored. Sums are the stored ones plus the added ones. Facts are never taken out and
    attributes of a version never change, so a greatest attribute only grows.
    """
    lists = attribute_lists(versions)
    if stored is None:
        return _valued(added.withColumn("_was_stored", F.lit(False)), lists, materials, "_was_stored")
    before = stored.join(lists, "warehouse_code").selectExpr(
        *MONTHLY_GROUP, *ADDED_UP,
        *[f"int(array_position({a}_list, {a})) AS {a}_place" for a in ATTRIBUTES],
        "price AS old_price", f"cast(NULL AS {MONEY}) AS price", f"false AS {REPRICED}", "true AS _was_stored",
    )
    after = added.selectExpr("*", f"cast(NULL AS {MONEY}) AS old_price", "false AS _was_stored")
    summed = before.unionByName(after).groupBy(*MONTHLY_GROUP).agg(
        *[F.expr(e) for e in EFFECT_SUMS],
        *[F.max(a).alias(a) for a in (*GREATEST, "old_price", REPRICED, "_was_stored")],
    )
    priced = summed.withColumn("price", F.expr(f"if({REPRICED}, price, greatest(price, old_price))"))
    return _valued(priced, lists, materials, "_was_stored")


# --- sums by warehouse and attributes --------------------------------------------------------------

# Group of the pre-aggregate, and its columns: rows, sums, and rows that have a value.
SLICE_KEYS = [*MONTH, "directorate", "shop_code", "warehouse_code", "warehouse_type"]


def signed_sums(rows: DataFrame, sign: int) -> DataFrame:
    """What rows of the detail mart add to (1) or take from (-1) the sums of their warehouse.

    A sum is null if no row has a value, so rows with a value are counted as well.
    """
    return rows.selectExpr(
        *SLICE_KEYS, f"{sign}L AS n",
        *[f"coalesce({m}, 0) * {sign} AS {m}" for m in SUMS],
        *[f"if({m} IS NULL, 0L, {sign}L) AS n_{m}" for m in SUMS],
    )


def added_sums(signed: DataFrame) -> DataFrame:
    """One row per warehouse, month and attributes; rows that cancel out are left out."""
    counts = ["n", *[f"n_{m}" for m in SUMS]]
    return signed.groupBy(*SLICE_KEYS).agg(
        *[F.sum(c).cast("long").alias(c) for c in counts],
        *[F.sum(m).cast("decimal(38,2)").alias(m) for m in SUMS],
    )


def pre_aggregate_of(sums: DataFrame) -> DataFrame:
    """The pre-aggregate of the levels from stored sums."""
    return sums.selectExpr(
        *SLICE_KEYS, "directorate AS max_directorate", "shop_code AS max_shop", "warehouse_type AS max_type",
        *[f"if(n_{m} = 0, NULL, {m}) AS {m}" for m in SUMS],
    )


def month_names(calendar: DataFrame) -> DataFrame:
    return calendar.filter("day_of_month = 1").select("year_num", "month_num", "month_name")


def _pre_aggregate(monthly: DataFrame) -> DataFrame:
    """Down to one row per month, warehouse and attributes before levels multiply rows.

    All attributes are group columns here, so nothing but sums is aggregated over the detail mart.
    ``directorate``, ``shop_code`` and ``warehouse_type`` come out a second time (``max_…``) as
    attributes of the warehouse level.
    """
    summed = monthly.groupBy(*SLICE_KEYS).agg(*[F.sum(m).alias(m) for m in SUMS])
    return summed.selectExpr(
        *SLICE_KEYS, "directorate AS max_directorate", "shop_code AS max_shop", "warehouse_type AS max_type",
        *SUMS,
    )


def level_sums(monthly: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """The three sums for each slice of each level, in one pass over the detail mart."""
    return level_sums_of(_pre_aggregate(monthly), levels)


def level_sums_of(aggregated: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """The same from the pre-aggregate."""
    groups = {
        COMPANY: MONTH,
        DIRECTORATE: [*MONTH, "directorate"],
        SHOP: [*MONTH, "directorate", "shop_code"],
        WAREHOUSE: [*MONTH, "warehouse_code"],
    }
    wanted = [groups[x] for x in (levels or LEVELS)]
    by = [*MONTH, "directorate", "shop_code", "warehouse_code"]
    sets = aggregated.groupingSets(wanted, *by).agg(
        F.expr(
            f"CASE WHEN grouping(warehouse_code) = 0 THEN '{WAREHOUSE}' "
            f"WHEN grouping(shop_code) = 0 THEN '{SHOP}' "
            f"WHEN grouping(directorate) = 0 THEN '{DIRECTORATE}' ELSE '{COMPANY}' END"
        ).alias("agg_level"),
        *[F.max(c).alias(c) for c in ("max_directorate", "max_shop", "max_type")],
        *[F.expr(f"cast(sum({m}) AS {MONEY}) AS {m}") for m in SUMS],
    )
    named = sets.filter(
        f"NOT (agg_level = '{DIRECTORATE}' AND coalesce(directorate, '') = '') "
        f"AND NOT (agg_level = '{SHOP}' AND coalesce(shop_code, '') = '')"
    )
    own = f"agg_level = '{WAREHOUSE}'"
    return named.selectExpr(
        *MONTH,
        "agg_level",
        f"CASE agg_level WHEN '{COMPANY}' THEN '{COMPANY_KEY}' WHEN '{DIRECTORATE}' THEN directorate "
        f"WHEN '{SHOP}' THEN concat(coalesce(directorate, ''), '{KEY_SEPARATOR}', shop_code) "
        "ELSE warehouse_code END AS agg_key",
        f"CASE WHEN {own} THEN max_directorate ELSE directorate END AS directorate",
        f"CASE WHEN {own} THEN max_shop ELSE shop_code END AS shop_code",
        "warehouse_code",
        f"CASE WHEN {own} THEN max_type END AS warehouse_type",
        *SUMS,
    )


def with_ratios(sums: DataFrame) -> DataFrame:
    """Ratios of the summed values, not means of ratios."""
    return sums.selectExpr(
        "*",
        f"{safe_ratio('expense_value', 'avg_stock_value', 4)} AS turnover_ratio",
        f"{safe_ratio('avg_stock_value * 30', 'expense_value', 2)} AS turnover_days",
    )


def with_mom(metrics: DataFrame) -> DataFrame:
    """Change against the previous calendar month of the same slice; a gap gives null.

    A slice has one row per month, so the row before is the previous month exactly when its key
    says so. That needs one shuffle on the slice instead of a self join.
    """
    row_before = f"lag(struct(month_key, {', '.join(COMPARED)}))"
    by_slice = "OVER (PARTITION BY agg_level, agg_key ORDER BY month_key)"
    adjacent = metrics.selectExpr("*", f"{row_before} {by_slice} AS before").withColumn(
        "before",
        F.expr(f"CASE WHEN before.month_key = {previous_month_key('month_key')} THEN before END"),
    )
    return adjacent.selectExpr(
        *metrics.columns,
        *[f"{safe_ratio(f'{m} - before.{m}', f'before.{m}', 4)} AS mom_{m}" for m in COMPARED],
    )


def turnover_metrics(
    monthly: DataFrame, calendar: DataFrame, levels: list[str] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All levels with ratios and month-over-month change.

    ``keep`` stores the pre-aggregate, so that what was moved for the detail mart goes before levels are formed.
    """
    aggregated = _pre_aggregate(monthly)
    return metrics_of(keep(aggregated) if keep else aggregated, calendar, levels)


def metrics_of(
    aggregated: DataFrame, calendar: DataFrame, levels: list[str] | None = None
) -> DataFrame:
    """The same from the pre-aggregate."""
    # One row per month of the calendar.
    sums = level_sums_of(aggregated, levels).join(
        F.broadcast(month_names(calendar)), ["year_num", "month_num"]
    )
    return with_mom(with_ratios(sums)).select(*METRIC_COLUMNS)


def vw_turnover_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select(*METRIC_COLUMNS)


def vw_inventory_monthly(monthly: DataFrame) -> DataFrame:
    return monthly.select(*MONTHLY_COLUMNS)


def vw_warehouse_hierarchy(metrics: DataFrame) -> DataFrame:
    return (
        metrics.filter(F.col("agg_level") == WAREHOUSE)
        .select("warehouse_code", "directorate", "shop_code", "warehouse_type")
        .distinct()
    )


def top_metrics(metrics: DataFrame, n: int = 20) -> DataFrame:
    return metrics.orderBy("agg_level", "month_key", "agg_key").limit(n)


def company_stock_series(metrics: DataFrame) -> DataFrame:
    return (
        metrics.filter(F.col("agg_level") == COMPANY)
        .select("month_key", "stock_value")
        .orderBy("month_key")
    )


# Level each role reads, and the column that narrows it to the reader's own zone.
ROLE_LEVELS = {
    "general_director": (COMPANY, None),
    "production_director": (DIRECTORATE, "directorate"),
    "purchasing_director": (DIRECTORATE, "directorate"),
    "purchasing_manager": (DIRECTORATE, "directorate"),
    "shop_head": (SHOP, "shop_code"),
    "warehouse_head": (WAREHOUSE, "warehouse_code"),
}


def role_slice(metrics: DataFrame, role: str, zone: list[str] | None = None) -> DataFrame:
    """What one reader sees; both filters reach the stored mart's scan."""
    level, column = ROLE_LEVELS[role]
    rows = metrics.filter(F.col("agg_level") == level)
    if column is None:
        return rows
    return rows.filter(F.col(column).isin(zone or []))


def with_zone(metrics: DataFrame) -> DataFrame:
    """The zone whose readers see a row; null where the whole level is one zone."""
    return metrics.selectExpr(
        "*", f"CASE agg_level WHEN '{DIRECTORATE}' THEN directorate WHEN '{SHOP}' THEN shop_code "
        f"WHEN '{WAREHOUSE}' THEN warehouse_code END AS zone"
    )


def publish_by_zone(metrics: DataFrame, table: Clustered, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The mart in the order in which roles read it: level, zone, month. ``metrics`` is a stored table."""
    write_clustered(with_zone(metrics), table, ["month_key"], rows_per_file)


def published_slice(spark: SparkSession, table: Clustered, role: str, zone: list[str] | None = None) -> DataFrame:
    """What one reader sees, from the files of the own level and zone only."""
    level, column = ROLE_LEVELS[role]
    wanted = [(level, None)] if column is None else [(level, z) for z in zone or []]
    return read_slice(spark, table, wanted).select(*METRIC_COLUMNS)


def entitled_slices(metrics: DataFrame, entitlements: DataFrame) -> DataFrame:
    """What every reader of a (reader, agg_level, zone) table sees of the own zone.

    Who sees a whole level has no zone and reads the mart through ``whole_level``; a copy of the
    level for each of them is not made.
    """
    zoned = with_zone(metrics)
    readers = entitlements.selectExpr(
        "reader", "agg_level AS reader_level", "zone AS reader_zone"
    ).distinct()
    seen = zoned.join(readers, F.expr("agg_level = reader_level AND zone = reader_zone"))
    return seen.select("reader", *METRIC_COLUMNS)


def whole_level(metrics: DataFrame, level: str) -> DataFrame:
    """A level for readers without a zone: a filter that reaches the stored mart's scan."""
    return metrics.filter(F.col("agg_level") == level)
