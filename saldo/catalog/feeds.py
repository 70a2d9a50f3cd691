"""The three feeds and the layers above them, derived from the given order tables.

The given tables hold no stock data. Suppliers stand for warehouses, parts for materials, shipped
lines for stock movements, event users for warehouses with a long history. Raw feeds are text with
planted defects; clean feeds have the shape of the clean layer.

All rows of the given tables take part; each order line is a row of the raw turnover feed. Remainders
of ids only decide what is planted: bad cells, later exports, rows that count as stored by an earlier
load, and further movements of parts without a price and of codes without a registry row.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import SERIAL_ZERO
from ..operators import facts, material
from ..operators import warehouse as wh
from ..operators.calendar import dim_date
from ..plans import marts
from ..schemas import MONEY, QTY, feed_columns
from ..session import brief_shuffles, remove_folder, scratch_path

# The calendar of lost_rows ends so many days early, so that some rows lie outside.
CUT_DAYS = 184
SNAPSHOT_DAYS = ["1995-01-10", "1997-01-10", "1999-01-10", "2001-01-10"]
# Event days up to this one count as loaded earlier.
LOADED_UNTIL = "2024-01-20"

MONTH_START = "cast(trunc(cast(l_shipdate AS date), 'month') AS date)"
MONTH = [f"{MONTH_START} AS start_date", f"last_day({MONTH_START}) AS end_date"]
UNITS = "array('шт', 'кг', 'м')"
LINE_COLUMNS = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
# Documents per exported text file, and lines per block of its digest.
BUNDLE, BUNDLE_LINES = 100, 50
# Planted parts have numbers above this, planted codes begin with this.
UNPRICED, UNREGISTERED = 1_000_000_000, "X"
# Numbers of lines within an order stay below this.
LINES_PER_ORDER = 100_000
EXPORT_DAY = "date_add(end_date, if(copy = 1, 17, 1))"


def _exprs(*texts: str) -> list[Column]:
    return [F.expr(t) for t in texts]


def _copies(**conditions: str) -> str:
    """explode() of copy numbers: 0 always, the others under their condition."""
    others = "".join(f", if({c}, {name[1:]}, NULL)" for name, c in conditions.items())
    return f"explode(array_compact(array(0{others}))) AS copy"


def _as_text(day: str) -> str:
    """The written forms in which exports deliver one date, chosen by ``form``."""
    serial = f"string(datediff({day}, DATE'{SERIAL_ZERO}'))"
    return (
        f"CASE form WHEN 0 THEN date_format({day}, 'yyyy-MM-dd') "
        f"WHEN 1 THEN date_format({day}, 'dd.MM.yyyy') "
        f"WHEN 2 THEN date_format({day}, 'dd/MM/yyyy') "
        f"WHEN 3 THEN {serial} WHEN 4 THEN concat({serial}, '.0') "
        f"WHEN 5 THEN date_format({day}, 'yyyyMMdd') "
        f"ELSE concat(date_format({day}, 'yyyy-MM-dd'), 'T10:00:00') END"
    )


def _as_texts(*days: str) -> str:
    """The same for several dates, as one array: written out date by date, the generated method outgrows
    what the JVM compiles."""
    return f"transform(array({', '.join(days)}), day -> {_as_text('day')}) AS texts"


def _plant(cell: str, **defects: str) -> str:
    """The cell, or a defect: d101='x' plants x where the row's ``mark`` is a multiple of 101."""
    cases = "".join(f"WHEN mark % {n[1:]} = 0 THEN {v} " for n, v in defects.items())
    return f"CASE {cases}ELSE {cell} END"


class Feeds:
    """Feeds and layers over one folder of given tables; each is built at most once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._stored: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- clean feeds ---------------------------------------------------------------------------

    @cached_property
    def turnover(self) -> DataFrame:
        """Warehouse, material and ship month; every fifth pair is exported a second time.

        Some pairs move a further part that no price was delivered for, some a part under a code that
        the registry does not know.
        """
        lines = self.table("lineitem").selectExpr(
            "l_suppkey", "l_partkey", "l_returnflag", *MONTH, f"cast(l_quantity AS {QTY}) AS q"
        )
        sums = lines.groupBy("l_suppkey", "l_partkey", "start_date", "end_date").agg(*_exprs(
            "sum(q) AS opening",
            "sum(if(l_returnflag = 'R', q, 0)) AS income",
            "sum(if(l_returnflag = 'R', 0, q)) AS outgo",
        ))
        exported = sums.selectExpr(
            "*", _copies(
                _1="(l_suppkey + l_partkey) % 5 = 0", _2="(l_suppkey + l_partkey) % 13 = 5",
                _3="(l_suppkey + l_partkey) % 11 = 3",
            )
        ).withColumn("opening", F.expr("opening + copy + (l_partkey % 10) * 0.001BD"))
        # Ties on the export date cannot occur here, so any number serves as load order.
        return exported.selectExpr(
            "l_partkey * 4 + copy AS load_id",
            f"{EXPORT_DAY} AS date",
            "start_date",
            "end_date",
            f"concat(if(copy = 3, '{UNREGISTERED}', ''), string(l_suppkey)) AS warehouse_code",
            f"int(l_partkey + 1 + if(copy = 2, {UNPRICED}, 0)) AS material_id",
            f"element_at({UNITS}, int(l_partkey % 3 + 1)) AS unit",
            f"cast(opening AS {QTY}) AS balance_start",
            f"cast(income AS {QTY}) AS income_qty",
            f"cast(-outgo AS {QTY}) AS expense_qty",
            f"cast(opening + income - outgo AS {QTY}) AS balance_end",
        )

    @cached_property
    def priced_months(self) -> DataFrame:
        """Part and month that occurs, with a price that moves by month."""
        months = self.table("lineitem").selectExpr("l_partkey", *MONTH).distinct()
        parts = self.table("part").selectExpr("p_partkey AS l_partkey", "p_retailprice")
        return months.join(parts, "l_partkey").selectExpr(
            "l_partkey", "start_date", "end_date",
            f"cast(cast(p_retailprice AS {MONEY}) + month(start_date) * 0.25 AS {MONEY}) AS price",
            "l_partkey * 1000 + (year(start_date) - 1990) * 12 + month(start_date) AS mark",
        )

    @cached_property
    def prices(self) -> DataFrame:
        """Every seventh part gets a corrected price in a later export."""
        return self.priced_months.selectExpr("*", _copies(_1="l_partkey % 7 = 0")).selectExpr(
            "mark * 4 + copy AS load_id",
            f"{EXPORT_DAY} AS date",
            "start_date",
            "end_date",
            "int(l_partkey + 1) AS material_id",
            f"cast(price + copy * 2 AS {MONEY}) AS price",
        )

    @cached_property
    def warehouses(self) -> DataFrame:
        """Registry snapshots of every supplier on four days."""
        nations = self.table("nation").selectExpr(
            "n_nationkey AS s_nationkey", "n_name", "n_regionkey AS r_regionkey"
        )
        placed = self.table("supplier").join(nations, "s_nationkey").join(self.table("region"), "r_regionkey")
        days = ", ".join(f"DATE'{d}'" for d in SNAPSHOT_DAYS)
        rows = placed.selectExpr("*", f"posexplode(array({days})) AS (step, day)")
        return rows.selectExpr(
            "s_suppkey * 4 + step AS load_id",
            "day AS date",
            "day AS start_date",
            "date_add(day, 30) AS end_date",
            "string(s_suppkey) AS warehouse_code",
            "if(s_suppkey % 17 <> 2, n_name, NULL) AS shop_code",
            "if(s_acctbal < 5000, 'MAIN', 'TRANSIT') AS warehouse_type",
            "if(s_suppkey % 6 = 0 AND step >= 2, 'RESERVE', r_name) AS directorate",
            "int(CASE WHEN s_suppkey % 19 <> 4 THEN s_nationkey + 1 "
            "+ if(s_suppkey % 3 = 0, step, 0) END) AS mol_id",
            "if(s_suppkey % 5 = 0, 'keeper', NULL) AS mol_position",
        )

    @cached_property
    def daily_states(self) -> DataFrame:
        """Event users as registry codes: one clean registry row per event, so days repeat."""
        day = "cast(ts AS date)"
        return self.table("events").selectExpr(
            "event_id AS load_id",
            f"{day} AS date",
            f"{day} AS start_date",
            f"{day} AS end_date",
            "string(user_id) AS warehouse_code",
            "event_type AS shop_code",
            "'MAIN' AS warehouse_type",
            "cast(NULL AS string) AS directorate",
            "cast(NULL AS int) AS mol_id",
            "cast(NULL AS string) AS mol_position",
        )

    # --- raw feeds -----------------------------------------------------------------------------

    def raw(self, feed: str) -> DataFrame:
        return getattr(self, f"raw_{feed}").select("load_id", "file_name", *feed_columns(feed))

    @cached_property
    def raw_turnover(self) -> DataFrame:
        """One text row per order line, plus later exports and plain repeats of some."""
        lines = self.table("lineitem")
        # Line numbers repeat within an order, so lines are counted; equal lines are interchangeable.
        copied = lines.selectExpr(
            "l_orderkey AS mark", "l_suppkey AS s", "l_partkey AS p", "l_returnflag AS f", *MONTH,
            f"l_orderkey * {LINES_PER_ORDER} + row_number() OVER (PARTITION BY l_orderkey "
            f"ORDER BY {', '.join(LINE_COLUMNS)}) AS number", "l_orderkey", "l_quantity",
        ).selectExpr(
            "mark", "s", "p", "f", "start_date", "end_date", "number",
            f"cast(cast(l_quantity AS {QTY}) + (l_orderkey % 1000) * 0.001BD AS {QTY}) AS exact",
            _copies(_1="l_orderkey % 5 = 0", _2="l_orderkey % 7 = 0"),
        )
        moved = copied.selectExpr(
            "*",
            "number % 7 AS form",
            f"cast(exact * 2 + int(copy = 1) AS {QTY}) AS opening",
            f"cast(if(f = 'R', exact, 0) AS {QTY}) AS income",
            f"cast(if(f = 'R', 0, -exact) AS {QTY}) AS expense",
        ).selectExpr(
            "*", f"cast(opening + income + expense AS {QTY}) AS closing",
            _as_texts(
                EXPORT_DAY, "if(mark % 131 = 0, end_date, start_date)", "if(mark % 131 = 0, start_date, end_date)"
            ),
        )
        material = "string(p + 1)"
        written = (
            f"CASE number % 3 WHEN 1 THEN concat({material}, '.0') "
            f"WHEN 2 THEN concat(' ', {material}, ' ') ELSE {material} END"
        )
        return moved.selectExpr(
            "number * 4 + copy AS load_id",
            "concat('turnover-', string(form), '.csv') AS file_name",
            f"{_plant('texts[0]', d101=repr('мусор'))} AS date",
            "texts[1] AS start_date",
            "texts[2] AS end_date",
            f"{_plant('string(s)', d107=repr('  '))} AS warehouse_code",
            f"{_plant(written, d149=repr('0'), d103=repr('x'))} AS material_id",
            f"{_plant(f'element_at({UNITS}, int(p % 3 + 1))', d109=repr(''))} AS unit",
            f"{_plant('string(opening)', d139=repr('-5'))} AS balance_start",
            f"{_plant('string(income)', d137=repr('1e3'))} AS income_qty",
            f"{_plant('string(expense)', d127=repr('3'))} AS expense_qty",
            _plant("string(closing)", d151="string(closing + 0.001BD)",
                   d113="string(closing + 0.002BD)") + " AS balance_end",
        )

    @cached_property
    def raw_prices(self) -> DataFrame:
        """Part and month as text rows, with a later export, a repeat, and bad cells."""
        copies = _copies(_1="l_partkey % 7 = 0", _2="l_partkey % 9 = 0")
        rows = self.priced_months.selectExpr("*", "mark % 7 AS form", copies)
        price = f"concat(string(cast(price + int(copy = 1) * 2 AS {MONEY})), '5')"
        return rows.selectExpr(
            "mark * 4 + copy AS load_id",
            "concat('prices-', string(form), '.csv') AS file_name",
            f"{_as_text(EXPORT_DAY)} AS date",
            f"{_plant(_as_text('start_date'), d101=repr('31.02.2024'))} AS start_date",
            f"{_as_text('end_date')} AS end_date",
            f"{_plant('string(l_partkey + 1)', d103=repr('-7'))} AS material_id",
            f"{_plant(price, d109=repr('12,5'), d107=repr('0'))} AS price",
        )

    @cached_property
    def raw_warehouses(self) -> DataFrame:
        """Registry snapshots as text rows, every seventh repeated, with bad cells."""
        rows = self.warehouses.selectExpr(
            "*", "load_id + 1 AS mark", "load_id % 7 AS form", _copies(_1="load_id % 7 = 0")
        )
        person = "concat(string(mol_id), '.0')"
        return rows.selectExpr(
            "load_id * 4 + copy AS load_id",
            "concat('warehouses-', string(form), '.csv') AS file_name",
            f"{_as_text('date')} AS date",
            f"{_as_text('start_date')} AS start_date",
            f"{_as_text('end_date')} AS end_date",
            f"{_plant('warehouse_code', d23=repr(' '))} AS warehouse_code",
            "shop_code",
            f"{_plant('warehouse_type', d29=repr(''))} AS warehouse_type",
            "directorate",
            f"{_plant(person, d37=repr('-1'), d31=repr('abc'))} AS mol_id",
            "mol_position",
        )

    # --- layers above the clean feeds ----------------------------------------------------------

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a layer and read it back, as the nightly load does between its steps.

        What several later steps need is then computed once, and Spark knows its size when it
        chooses a join. What was shuffled for it is removed.
        """
        folder = self._stored[name] = scratch_path(self.spark, name)
        with brief_shuffles(self.spark):
            rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def release(self, *names: str) -> None:
        """Remove what was stored last under these names; nothing that is still to run may read it.

        A layer that is asked for again is built again.
        """
        for name in names:
            if name in self._stored:
                remove_folder(self.spark, self._stored.pop(name))
            self.__dict__.pop(name.replace("-", "_"), None)

    @cached_property
    def bounds(self) -> tuple[date, date]:
        """First and last day of the years in which orders or shipments fall."""
        days = self.table("lineitem").selectExpr("l_shipdate AS day").union(
            self.table("orders").selectExpr("o_orderdate AS day")
        )
        first, last = days.selectExpr("year(min(day))", "year(max(day))").first()
        # Without a single row any calendar serves.
        return date(first or 1995, 1, 1), date(last or 1995, 12, 31)

    @cached_property
    def calendar(self) -> DataFrame:
        return dim_date(self.spark, *self.bounds)

    @cached_property
    def short_calendar(self) -> DataFrame:
        first, last = self.bounds
        return dim_date(self.spark, first, last - timedelta(days=CUT_DAYS))

    @cached_property
    def ods_turnover(self) -> DataFrame:
        return self.store("ods-turnover", self.turnover)

    @cached_property
    def ods_prices(self) -> DataFrame:
        return self.store("ods-prices", self.prices)

    @cached_property
    def materials(self) -> DataFrame:
        master = material.material_master(self.ods_turnover, self.ods_prices)
        rows = master.selectExpr(material.MATERIAL_SK, "material_id", "unit")
        return self.store("dim-material", rows)

    @cached_property
    def registered(self) -> DataFrame:
        """Versions of the codes that the registry knows."""
        built = wh.build_versions(wh.changes(wh.snapshots(self.warehouses)))
        return self.store("registered", built)

    @cached_property
    def versions(self) -> DataFrame:
        return self.store("dim-warehouse", wh.with_unknown(self.registered, self.ods_turnover))

    @cached_property
    def inventory(self) -> DataFrame:
        rows = facts.inventory_rows(self.ods_turnover, self.calendar, self.versions)
        return self.store("fact-inventory", rows)

    @cached_property
    def price_facts(self) -> DataFrame:
        return self.store("fact-prices", facts.price_rows(self.ods_prices, self.calendar))

    @cached_property
    def monthly(self) -> DataFrame:
        layers = self.inventory, self.price_facts, self.calendar, self.materials, self.versions
        # Facts and dimensions are stored; nothing lazy is left above the clean layer.
        self.release("ods-turnover", "ods-prices")
        return marts.inventory_monthly(*layers)

    @cached_property
    def daily_changes(self) -> DataFrame:
        return self.store("daily-changes", wh.changes(wh.snapshots(self.daily_states)))

    @cached_property
    def stored_versions(self) -> DataFrame:
        """Versions as a load on LOADED_UNTIL left them."""
        early = self.daily_states.filter(f"date <= DATE'{LOADED_UNTIL}'")
        built = wh.build_versions(wh.changes(wh.snapshots(early)))
        return self.store("stored-versions", built)
