"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blank_to_null, parse_date, safe_ratio, to_int, to_price, to_qty
from ..operators import calendar as cal
from ..operators import dedup, facts, material, quality, rules
from ..operators import warehouse as wh
from ..operators.cleaning import clean
from ..plans import marts, reports
from ..plans.nightly import FEED_ORDER, Options, run_nightly
from ..schemas import BUSINESS_KEYS, FEED_COLUMNS, MONEY, QUANTITIES, WAREHOUSE_ATTRIBUTES
from ..session import remove_folder, scratch_path
from ..sources import delimited, files
from ..sources.clustered import Clustered
from ..sources.keyindex import KeyIndex, Segment
from ..sources.layers import Layers
from ..streaming.landing import load_stream
from .feeds import BUNDLE, BUNDLE_LINES, Feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

VERSION = ["warehouse_code", *WAREHOUSE_ATTRIBUTES, "date_from", "date_to"]
IS_CURRENT = "int(is_current) AS is_current"


def query(name: str):
    """Register a function of the derived feeds under the query's name."""

    def register(function: Callable[[Feeds], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Feeds(spark, folder))
        return function

    return register


# --- files -------------------------------------------------------------------------------------


def _export(f: Feeds, feed: str) -> str:
    folder = scratch_path(f.spark, feed)
    delimited.export(f.raw(feed), feed, folder)
    return folder


def _scan(feed: str):
    def run(f: Feeds) -> DataFrame:
        rows = delimited.scan(f.spark, feed, _export(f, feed))
        return rows.drop("file_name")

    return run


for _feed in FEED_COLUMNS:
    query(f"scan_{_feed}")(_scan(_feed))


@query("scan_quoted")
def scan_quoted(f):
    """Documents as cells with line breaks and quotes; the files are read in pieces."""
    folder = scratch_path(f.spark, "quoted")
    others = [f"cast(NULL AS string) AS {c}" for c in FEED_COLUMNS["warehouses"][:-2]]
    cells = f.table("documents").selectExpr(*others, "string(doc_id) AS mol_id", "text AS mol_position")
    delimited.export(cells, "warehouses", folder)
    rows = delimited.scan(
        f.spark, "warehouses", folder, quoted_breaks=True, keep=lambda lines: f.store("quoted-lines", lines)
    )
    return rows.selectExpr(
        "bigint(mol_id) AS doc_id", "sha2(encode(mol_position, 'utf-8'), 256) AS digest",
        "char_length(mol_position) AS n_chars",
    )


@query("export_delimited")
def export_delimited(f):
    """What the written files hold, as plain text lines."""
    lines = f.spark.read.schema("line string").csv(
        _export(f, "prices"), sep="\x01", quote="", encoding="UTF-16LE", lineSep="\n",
        header=True, enforceSchema=True,
    )
    return lines.groupBy("line").agg(F.count("*").alias("n"))


@query("staging_append")
def staging_append(f):
    """Load numbers of a second load: above those of the first, without gaps, file after file."""
    previous = 10**12
    folder = _export(f, "turnover")
    staged = f.store("staged", delimited.scan(f.spark, "turnover", folder, positions=True))
    remove_folder(f.spark, folder)  # its rows are staged
    numbered = f.store("numbered", delimited.with_load_id(staged, previous))
    f.release("staged")
    by_file = numbered.groupBy("file_name").agg(
        F.min("load_id").alias("low"), F.max("load_id").alias("high"), F.count("*").alias("n")
    ).selectExpr("*", "lag(high) OVER (ORDER BY file_name) AS before")
    in_order = f"low = coalesce(before, {previous}) + 1 AND high - low + 1 = n"
    return by_file.selectExpr(
        "sum(n) AS n_rows",
        f"max(high) - {previous} AS highest",
        "count_if(file_name IS NULL) AS n_without_file",
        f"int(every({in_order})) AS is_in_order",
    )


def _orders_by_month(f: Feeds, name: str, condition: str = "true") -> str:
    """One folder of files per month of the orders."""
    folder = scratch_path(f.spark, name)
    months = f.table("orders").withColumn("month", F.expr("date_format(o_orderdate, 'yyyy-MM')"))
    months.filter(condition).hint("rebalance", "month").write.partitionBy("month").parquet(folder)
    return folder


def _monthly_files(f: Feeds, folder: str) -> DataFrame:
    """The exported files, named by their month."""
    found = files.list_files(f.spark, folder, "*.parquet", recursive=True)
    return found.withColumn("path", F.regexp_replace("path", r"/month=([^/]*)/[^/]*\z", "/$1.csv"))


@query("file_listing")
def file_listing(f):
    """What a listing finds of an export of the orders."""
    listed = _monthly_files(f, _orders_by_month(f, "orders"))
    return listed.select(files.file_name(F.col("path")).alias("file_name")).distinct()


@query("stale_outputs")
def stale_outputs(f):
    """Months of the orders of which no newer output exists: none was made for every fifth month."""
    source = _orders_by_month(f, "orders")
    output = _orders_by_month(f, "outputs", "month(o_orderdate) % 5 <> 0")
    found, done = _monthly_files(f, source), _monthly_files(f, output)
    return files.stale_outputs(found, done, source, output).select("stem").distinct()


def _documents(f: Feeds) -> DataFrame:
    """Each document as a file."""
    return f.table("documents").selectExpr(
        "concat('/import/', string(doc_id), '.csv') AS path", "doc_id",
        "encode(text, 'utf-8') AS content", "length(encode(text, 'utf-8')) AS length",
    )


def _whole_registry(f: Feeds) -> DataFrame:
    """Of the documents a fifth each was loaded with other content, failed, or is pending; the rest
    was loaded as it is."""
    kind = "doc_id % 5"
    return _documents(f).selectExpr(
        "'documents' AS source_type",
        "element_at(split(path, '/'), -1) AS file_name",
        "path AS file_path",
        f"if({kind} = 1, repeat('0', 64), {files.content_digest('content', 'length')}) AS file_hash",
        "bigint(length) AS file_size_bytes",
        f"CASE {kind} WHEN 2 THEN 'failed' WHEN 3 THEN 'pending' ELSE 'loaded' END AS status",
        "1L AS rows_loaded",
        "cast(NULL AS timestamp) AS loaded_at",
        f"CASE {kind} WHEN 2 THEN 'unreadable' END AS error_message",
        "cast(NULL AS timestamp) AS modified_at",
    )


def _document_registry(f: Feeds) -> DataFrame:
    """The registry before every fifth document arrived: those are new."""
    number = "int(split_part(file_name, '.', 1))"
    return _whole_registry(f).filter(f"{number} % 5 <> 0")


def _decided(f: Feeds) -> DataFrame:
    return files.decide(files.fingerprint(_documents(f)), _document_registry(f))


@query("file_fingerprint")
def file_fingerprint(f):
    return files.fingerprint(_documents(f))


@query("file_fingerprint_large")
def file_fingerprint_large(f):
    """Digests of text files with a hundred documents each, read in pieces by many tasks."""
    folder = scratch_path(f.spark, "bundles")
    bundled = f.table("documents").selectExpr(
        f"doc_id div {BUNDLE} AS bundle", "doc_id", "coalesce(text, '') AS value"
    )
    bundled.repartition("bundle").sortWithinPartitions("bundle", "doc_id").drop("doc_id").write.partitionBy(
        "bundle"
    ).option("lineSep", "\n").text(folder)
    found = files.list_files(f.spark, folder, "*.txt", recursive=True)
    prints = files.fingerprint_large(found, lambda lines: f.store("lines", lines), BUNDLE_LINES)
    return prints.selectExpr(
        r"int(regexp_extract(file_path, 'bundle=([0-9]+)', 1)) AS bundle", "file_hash", "file_size_bytes"
    )


query("file_decision")(_decided)


@query("registry_upsert")
def registry_upsert(f):
    decided = _decided(f)
    counts = decided.selectExpr("file_path", "2L AS rows_loaded")
    outcome = files.outcome_rows(decided, "documents", "loaded", counts)
    return files.update_registry(_document_registry(f), outcome).drop("loaded_at", "modified_at")


@query("file_status")
def file_status(f):
    return reports.file_status(_whole_registry(f))


# --- scalar functions --------------------------------------------------------------------------


def _cell(column: str, function, feed: str = "turnover"):
    return lambda f: f.raw(feed).selectExpr(
        "load_id", f"{column} AS raw", f"{function(column)} AS parsed"
    )


query("parse_date")(_cell("date", parse_date))
query("blank_to_null")(_cell("warehouse_code", blank_to_null))
query("to_int")(_cell("material_id", to_int))
query("to_qty")(_cell("income_qty", to_qty))
query("to_price")(_cell("price", to_price, "prices"))


@query("safe_ratio")
def ratio_per_order(f):
    """Discount over tax per order, at four digits; some taxes are zero."""
    sums = f.table("lineitem").groupBy("l_orderkey").agg(
        F.expr(f"cast(sum(cast(l_discount AS {MONEY})) AS {MONEY})").alias("num"),
        F.expr(f"cast(sum(cast(l_tax AS {MONEY})) AS {MONEY})").alias("den"),
    )
    return sums.selectExpr(
        "l_orderkey", f"{safe_ratio('num', 'den', 4)} AS share",
        f"{safe_ratio('num - den', 'den', 4)} AS change",
    )


@query("dim_date")
def dim_date(f):
    """The calendar, with the number of orders on each day."""
    orders = f.table("orders").selectExpr("cast(o_orderdate AS date) AS full_date")
    per_day = orders.groupBy("full_date").agg(F.count("*").alias("n"))
    return f.calendar.join(per_day, "full_date", "left").selectExpr(
        "date_key", "full_date", "year_num", "quarter_num", "month_num", "month_name",
        "day_of_month", "day_of_week", "int(is_weekend) AS is_weekend",
        "coalesce(n, 0) AS n_orders",
    )


# --- cleaning and rules ------------------------------------------------------------------------


def _reasoned(f: Feeds, feed: str) -> DataFrame:
    return rules.with_reason(clean(f.raw(feed), feed), feed)


# What routing reads of checked rows: the clean layer takes typed values, the quarantine those delivered.
ROUTED = ["load_id", "error_reason"]


def _raw_columns(feed: str) -> list[str]:
    return ["file_name", *[f"raw_{c}" for c in FEED_COLUMNS[feed]]]


def _checked(f: Feeds, feed: str, needed: list[str] = ()) -> DataFrame:
    """Parsed once, written and read back, as the nightly load does before it routes rows.

    Only the reason, the business key and the columns ``needed`` beyond are written.
    """
    columns = dict.fromkeys([*ROUTED, *BUSINESS_KEYS[feed], *needed])
    return f.store(f"checked-{feed}", _reasoned(f, feed).select(*columns))


def _flag(f: Feeds, feed: str, checked: DataFrame) -> DataFrame:
    return dedup.flag_duplicates(
        checked, feed, keep_losing=lambda losing: f.store(f"losing-{feed}", losing)
    )


def _flagged(f: Feeds, feed: str = "turnover", needed: list[str] = ()) -> DataFrame:
    return _flag(f, feed, _checked(f, feed, needed))


def _clean(feed: str):
    return lambda f: clean(f.raw(feed), feed)


def _validate(feed: str):
    return lambda f: _reasoned(f, feed).select("load_id", *FEED_COLUMNS[feed], "error_reason")


def _deduplicated(feed: str):
    return lambda f: _flagged(f, feed).select("load_id", "error_reason")


for _feed in FEED_COLUMNS:
    query(f"clean_{_feed}")(_clean(_feed))
    query(f"validate_{_feed}")(_validate(_feed))
    query(f"dedup_{_feed}")(_deduplicated(_feed))


@query("error_reason")
def error_reason(f):
    return _checked(f, "turnover").filter("error_reason IS NOT NULL").select(
        "load_id", "error_reason"
    )


@query("balance_check")
def balance_check(f):
    cleaned = clean(f.raw("turnover"), "turnover")
    gaps = cleaned.selectExpr("load_id", f"cast({rules.BALANCE_GAP} AS decimal(18,3)) AS gap")
    return gaps.filter(f"gap > {rules.BALANCE_TOLERANCE}")


@query("flag_duplicates")
def flag_duplicates(f):
    """Duplicates inside the feed, with their business key."""
    return _flagged(f).filter(F.col("error_reason") == rules.DUPLICATE).select(
        "load_id", *BUSINESS_KEYS["turnover"]
    )


@query("route_valid")
def route_valid(f):
    return rules.split_valid(_flagged(f, needed=FEED_COLUMNS["turnover"]), "turnover")


@query("route_quarantine")
def route_quarantine(f):
    return rules.split_quarantine(_flagged(f, needed=_raw_columns("turnover")), "turnover")


# Part of the feed that counts as stored by an earlier load.
EARLIER = "load_id % 8 < 4"


@query("quarantine_new")
def quarantine_new(f):
    """Quarantined rows that an earlier load has not quarantined yet."""
    rows = rules.split_quarantine(_flagged(f, needed=_raw_columns("turnover")), "turnover")
    return dedup.unseen(rows, rows.filter(EARLIER), ["load_id"])


@query("ods_new")
def ods_new(f):
    """Clean rows of a later load: their key must be new to the clean layer as well."""
    checked = _checked(f, "turnover", FEED_COLUMNS["turnover"])
    keys = BUSINESS_KEYS["turnover"]
    stored = f.store("ods-keys", rules.split_valid(checked.filter(EARLIER), "turnover").select(*keys).distinct())
    index = KeyIndex(f.spark, keys, buckets=8)
    for part in (0, 1):  # as two loads left them
        index.add(
            stored.filter(f"material_id % 2 = {part}"),
            Segment(scratch_path(f.spark, "keys"), scratch_path(f.spark, "filter")),
        )
    later = checked.filter(f"NOT ({EARLIER})")
    flagged = dedup.flag_duplicates(
        later, "turnover", lambda rows: index.known(rows, lambda some: f.store("candidates", some)),
        lambda first: f.store("first", first),
    )
    return rules.split_valid(flagged, "turnover")


# --- dimensions --------------------------------------------------------------------------------


def _master(f: Feeds) -> DataFrame:
    return material.material_master(f.turnover, f.prices)


query("material_master")(_master)


@query("scd1_material")
def scd1_material(f):
    """Parts as stored materials: some units unknown, some outdated, some materials missing."""
    stored = f.table("part").filter("p_partkey % 5 <> 0").selectExpr(
        "int(p_partkey + 1) AS material_id",
        "CASE p_partkey % 5 WHEN 1 THEN 'т' WHEN 2 THEN 'шт' END AS unit",
    )
    return material.merge_materials(stored, _master(f)).select("material_id", "unit")


@query("warehouse_snapshots")
def warehouse_snapshots(f):
    return wh.snapshots(f.daily_states).select("warehouse_code", "snapshot_date", "shop_code")


@query("warehouse_changes")
def warehouse_changes(f):
    return f.daily_changes.select("warehouse_code", "snapshot_date", "shop_code")


@query("scd2_build")
def scd2_build(f):
    built = wh.build_versions(wh.changes(wh.snapshots(f.warehouses)))
    return built.selectExpr(*VERSION, IS_CURRENT)


def _pending(f: Feeds) -> DataFrame:
    return wh.pending_changes(f.stored_versions, f.daily_changes)


def _dated(versions: DataFrame) -> DataFrame:
    return versions.selectExpr("warehouse_code", "shop_code", "date_from", "date_to", IS_CURRENT)


@query("scd2_increment")
def scd2_increment(f):
    return _pending(f).select("warehouse_code", "snapshot_date", "shop_code")


@query("scd2_close")
def scd2_close(f):
    return _dated(wh.close_versions(f.stored_versions, _pending(f)))


@query("scd2_open")
def scd2_open(f):
    return _dated(wh.open_versions(_pending(f)))


@query("unknown_members")
def unknown_members(f):
    return wh.unknown_members(f.turnover, f.registered).selectExpr(*VERSION, IS_CURRENT)


# --- facts -------------------------------------------------------------------------------------


@query("latest_turnover")
def latest_turnover(f):
    return facts.latest_turnover(f.turnover)


@query("latest_prices")
def latest_prices(f):
    return facts.latest_prices(f.prices)


@query("date_keys")
def date_keys(f):
    return cal.with_date_keys(f.turnover, f.calendar).select(
        "warehouse_code", "material_id", "date", "date_key_start", "date_key_end"
    )


@query("material_key")
def material_key(f):
    """Turnover rows of materials that are known here: those with a price."""
    known = f.prices.select("material_id").distinct().selectExpr(
        "material_id", material.MATERIAL_SK
    )
    return material.with_material_key(f.turnover, known).groupBy("material_id").agg(
        F.count("*").alias("n_rows"), F.countDistinct("material_sk").alias("n_keys")
    )


# Generated keys are engine-specific; the first day of the version is shown instead.
RESOLVED = ["warehouse_code", "material_id", "start_date", "date", "date_from"]


@query("scd2_asof")
def scd2_asof(f):
    return wh.version_on_date(f.ods_turnover, f.registered).select(*RESOLVED)


@query("scd2_fallback")
def scd2_fallback(f):
    return wh.resolve_version(f.ods_turnover, f.versions).select(*RESOLVED)


def _seen_earlier(f: Feeds) -> str:
    """Exports an earlier load saw: first exports only, nothing of the last year."""
    return f"date = date_add(end_date, 1) AND year(start_date) < {f.bounds[1].year}"


def _upserted(f: Feeds) -> DataFrame:
    stored = facts.inventory_rows(f.ods_turnover.filter(_seen_earlier(f)), f.calendar, f.versions)
    return facts.upsert_inventory(stored, f.inventory)


def _named(f: Feeds, rows: DataFrame, *columns: str) -> DataFrame:
    versions = f.versions.select("warehouse_sk", "warehouse_code", "date_from")
    materials = f.materials.select("material_sk", "material_id")
    return rows.join(versions, "warehouse_sk").join(materials, "material_sk").select(
        "date_key_start", "date_key_end", "warehouse_code", "date_from", "material_id", *columns
    )


def _with_material_id(f: Feeds, rows: DataFrame) -> DataFrame:
    materials = f.materials.select("material_sk", "material_id")
    return rows.join(materials, "material_sk").drop("material_sk")


@query("upsert_inventory")
def upsert_inventory(f):
    return _named(f, _upserted(f), *QUANTITIES, "action")


@query("upsert_prices")
def upsert_prices(f):
    stored = facts.price_rows(f.ods_prices.filter(_seen_earlier(f)), f.calendar)
    return _with_material_id(f, facts.upsert_prices(stored, f.price_facts))


@query("price_lookup")
def price_lookup(f):
    return _named(f, marts.with_price(f.inventory, f.price_facts), "balance_end", "price")


@query("star_join")
def star_join(f):
    rows = marts.star_rows(f.inventory, f.calendar, f.materials, f.versions)
    return rows.select(
        "date_key_start", "date_key_end", "year_num", "month_num", "warehouse_code", "directorate",
        "shop_code", "warehouse_type", "material_id", "unit", *QUANTITIES,
    )


# --- marts and views ---------------------------------------------------------------------------


@query("inventory_monthly")
def inventory_monthly(f):
    return f.monthly


def _metrics(f: Feeds, levels: list[str] | None = None) -> DataFrame:
    return marts.turnover_metrics(
        f.monthly, f.calendar, levels, lambda sums: f.store("warehouse-sums", sums)
    )


query("turnover_metrics")(_metrics)


def _level(level: str):
    return lambda f: _metrics(f, [level])


for _name in marts.LEVELS:
    query(f"metrics_{_name}")(_level(_name))


@query("mom")
def mom(f):
    changed = [f"mom_{m}" for m in marts.COMPARED]
    return _metrics(f).select("month_key", "agg_level", "agg_key", *changed)


@query("vw_turnover_metrics")
def vw_turnover_metrics(f):
    return marts.vw_turnover_metrics(_metrics(f))


@query("vw_inventory_monthly")
def vw_inventory_monthly(f):
    return marts.vw_inventory_monthly(f.monthly)


@query("vw_warehouse_hierarchy")
def vw_warehouse_hierarchy(f):
    return marts.vw_warehouse_hierarchy(_metrics(f, [marts.WAREHOUSE]))


@query("top_metrics")
def top_metrics(f):
    return marts.top_metrics(_metrics(f))


@query("company_stock_series")
def company_stock_series(f):
    return marts.company_stock_series(_metrics(f, [marts.COMPANY]))


@query("role_slice")
def role_slice(f):
    """One reader per region, nation and supplier, and one who sees all warehouses."""
    zones = {
        "region": ("director", marts.DIRECTORATE, "r_name"),
        "nation": ("shop head", marts.SHOP, "n_name"),
        "supplier": ("keeper", marts.WAREHOUSE, "string(s_suppkey)"),
    }
    readers = None
    for table, (title, level, zone) in zones.items():
        some = f.table(table).selectExpr(
            f"concat('{title} ', {zone}) AS reader", f"'{level}' AS agg_level", f"{zone} AS zone"
        )
        readers = some if readers is None else readers.unionByName(some)
    metrics = f.store("metrics", _metrics(f))
    chief = marts.whole_level(metrics, marts.WAREHOUSE).withColumn("reader", F.lit("chief"))
    return marts.entitled_slices(metrics, readers).unionByName(chief).select(
        "reader", "month_key", "agg_level", "agg_key", "stock_value", "turnover_ratio"
    )


# Zones that the six roles read here: names of regions and nations, warehouse codes.
ROLE_ZONES = {
    "general_director": None, "production_director": ["ASIA", "EUROPE"],
    "purchasing_director": ["AFRICA"], "purchasing_manager": ["AMERICA", "MIDDLE EAST"],
    "shop_head": ["FRANCE", "CHINA"], "warehouse_head": ["1", "2", "3"],
}


@query("role_views")
def role_views(f):
    """What each of the six roles reads of the stored mart."""
    metrics = f.store("metrics", _metrics(f))
    views = None
    for role, zone in ROLE_ZONES.items():
        view = marts.role_slice(metrics, role, zone).select(
            F.lit(role).alias("role"), "month_key", "agg_level", "agg_key", "stock_value",
            "mom_stock_value",
        )
        views = view if views is None else views.unionByName(view)
    return views


@query("role_views_clustered")
def role_views_clustered(f):
    """The same views of the mart laid out by level and zone; each reads the files of its zones."""
    table = Clustered(scratch_path(f.spark, "by-zone"), scratch_path(f.spark, "ranges"), ("agg_level", "zone"))
    marts.publish_by_zone(f.store("metrics", _metrics(f)), table, rows_per_file=1000)
    views = None
    for role, zone in ROLE_ZONES.items():
        view = marts.published_slice(f.spark, table, role, zone).select(
            F.lit(role).alias("role"), "month_key", "agg_level", "agg_key", "stock_value", "mom_stock_value",
        )
        views = view if views is None else views.unionByName(view)
    return views


# --- the nightly load --------------------------------------------------------------------------


# What two loads of a folder left, for the queries of one session that read it.
_LOADED: dict[tuple[str, str], Layers] = {}


def _two_loads(f: Feeds) -> Layers:
    """The registry and what an earlier load saw in one night, everything else in the next."""
    name = f.spark.sparkContext.applicationId, f.folder
    if name not in _LOADED:
        _LOADED[name] = _run_two_loads(f)
    return _LOADED[name]


def _run_two_loads(f: Feeds) -> Layers:
    landing, state = scratch_path(f.spark, "landing"), scratch_path(f.spark, "state")
    for number, seen in (("1", True), ("2", False)):
        for feed in FEED_ORDER:
            rows = getattr(f, feed)
            if feed != "warehouses":
                rows = rows.filter(_seen_earlier(f) if seen else f"NOT ({_seen_earlier(f)})")
            elif not seen:
                continue
            # Each night delivers into folders of its own.
            delimited.export(rows, feed, f"{landing}/{number}/{feed}")
        layers = run_nightly(f.spark, f"{landing}/{number}", state, Options(*f.bounds))
    return layers


@query("nightly_two_loads")
def nightly_two_loads(f):
    """The mart after two loads; the second only adds what its rows change."""
    return _two_loads(f).read("datamart/turnover_metrics").select(*marts.METRIC_COLUMNS)


@query("stream_load")
def stream_load(f):
    """The mart after everything delivered was loaded by the file stream."""
    landing, state = scratch_path(f.spark, "landing"), scratch_path(f.spark, "state")
    for feed in FEED_ORDER:
        delimited.export(getattr(f, feed), feed, f"{landing}/{feed}")
    layers = load_stream(f.spark, landing, state, scratch_path(f.spark, "checkpoint"), Options(*f.bounds))
    return layers.read("datamart/turnover_metrics").select(*marts.METRIC_COLUMNS)


@query("nightly_counts")
def nightly_counts(f):
    """Rows per layer as the second load reports them; they were counted while they were written."""
    layers = _two_loads(f)
    newest = layers.read("elt/layer_counts", [f"batch={layers.batch}"])
    return newest.filter("layer IN ('dwh', 'ods', 'datamart') AND feed <> 'dim_date'")


# --- checks and reports ------------------------------------------------------------------------


@query("check_unique")
def check_unique(f):
    sound = _checked(f, "turnover").filter("error_reason IS NULL")
    return quality.duplicate_keys(sound, BUSINESS_KEYS["turnover"])


@query("check_fk")
def check_fk(f):
    return quality.orphans(f.turnover, f.registered.select("warehouse_code"), ["warehouse_code"])


@query("check_constraints")
def check_constraints(f):
    """Unique and foreign keys, where some facts occur twice and every dimension lacks members."""
    inventory = f.store("inventory", f.inventory.join(f.materials, "material_sk"))
    twice = inventory.unionByName(inventory.filter("material_id % 7 = 0")).drop("material_id", "unit")
    materials = f.materials.filter("material_id % 13 <> 6")
    return quality.constraint_report(
        twice, f.price_facts, f.short_calendar, materials, f.registered
    )


@query("check_scd2")
def check_scd2(f):
    """Versions with planted faults: a day too long, reversed, or current although closed."""
    code = "int(warehouse_code)"
    broken = f.stored_versions.selectExpr(
        "warehouse_code", "date_from",
        f"CASE WHEN {code} % 7 = 0 AND NOT is_current THEN date_add(date_to, 1) "
        f"WHEN {code} % 11 = 0 AND NOT is_current THEN date_sub(date_from, 1) "
        "ELSE date_to END AS date_to",
        f"is_current OR {code} % 13 = 0 AS is_current",
    )
    return quality.broken_versions(broken).selectExpr(
        "warehouse_code", "date_from", "date_to", IS_CURRENT, "problem"
    )


@query("layer_counts")
def layer_counts(f):
    layers = {}
    for feed in FEED_COLUMNS:
        # A checked row for each raw one; it is made once, and duplicates are looked up once for both layers.
        checked = layers["staging", feed] = _checked(f, feed)
        flagged = f.store(f"flagged-{feed}", _flag(f, feed, checked).select("error_reason"))
        f.release(f"losing-{feed}")
        layers["ods", feed] = flagged.filter("error_reason IS NULL")
        layers["quarantine", feed] = flagged.filter("error_reason IS NOT NULL")
    layers["dwh", "inventory"], layers["dwh", "prices"] = f.inventory, f.price_facts
    layers["datamart", "monthly"] = f.monthly
    layers["skipped", "documents"] = _decided(f).filter(F.col("decision") == files.SKIP)
    return reports.layer_counts(layers)


@query("quarantine_reasons")
def quarantine_reasons(f):
    return reports.quarantine_reasons(rules.split_quarantine(_flagged(f, needed=_raw_columns("turnover")), "turnover"))


@query("unknown_share")
def unknown_share(f):
    return reports.unknown_share(f.ods_turnover, f.versions)


@query("lost_rows")
def lost_rows(f):
    """Rows lost to a calendar that ends early, and to materials without a price."""
    known = f.prices.select("material_id").distinct()
    return reports.lost_rows(f.ods_turnover, f.short_calendar, known)


@query("version_overlap")
def version_overlap(f):
    return _with_material_id(f, reports.version_overlap(_upserted(f), f.versions))
