"""Golden cells and rows, one per operator and per easily missed behaviour."""

import os
import random
import re
import time
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldo.functions import parse_date, previous_month_key, safe_ratio, to_int, to_price, to_qty
from saldo.operators import asof, dedup, facts, merge, quality, rules
from saldo.operators import warehouse as wh
from saldo.operators.calendar import dim_date, outside_calendar, with_date_keys
from saldo.operators.cleaning import clean
from saldo.operators.material import merge_materials
from saldo.plans import marts, reports
from saldo.schemas import FEED_COLUMNS, REGISTRY_SCHEMA, feed_columns, raw_schema
from saldo.session import BRIEF_SHUFFLES, brief_shuffles
from saldo.sources import delimited, files
from saldo.sources.layers import Layers

D = Decimal
APRIL = (date(2024, 4, 1), date(2024, 4, 30))


def evaluate(spark, function, cells):
    frame = spark.createDataFrame([(c,) for c in cells], "cell string")
    return [r[0] for r in frame.selectExpr(f"{function('cell')} AS value").collect()]


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=str)


DATES = {
    "45292": date(2024, 1, 1), "45323.0": date(2024, 2, 1), "2024-01-31": date(2024, 1, 31),
    "31.01.2024": date(2024, 1, 31), "31/01/2024": date(2024, 1, 31), "мусор": None, "": None,
    "20240131": date(2024, 1, 31), "2024-01-31 10:00:00": date(2024, 1, 31),
    "2024-01-31T10:00:00": date(2024, 1, 31), "2024-01-31T25:00:00": None,
    "2024.01.31": date(2024, 1, 31), " 45292 ": date(2024, 1, 1), "45323.999": date(2024, 2, 2),
    "45,292": None, "20241399": None, "9999999": None, "2958465": date(9999, 12, 31),
    "31.02.2024": None, "1.2.2024": date(2024, 2, 1), "12": date(1900, 1, 11), "2024": date(1905, 7, 16),
    "1.2/2024": None, "-5": None, ".": None,
}
INTEGERS = {"391": 391, "391.0": 391, "391.7": 391, "391.999": 392, "abc": None, "1e3": None,
            "-7": -7, "99999999999": None, "": None}
QUANTITIES = {"0.482": D("0.482"), "0.003": D("0.003"), "1,5": None, " 5 ": D("5.000"), "": None,
              "1e3": None}
PRICES = {"33": D("33.00"), "33.335": D("33.34"), "-1": D("-1.00"), "5\n": None}


@pytest.mark.parametrize("function, golden", [
    (parse_date, DATES), (to_int, INTEGERS), (to_qty, QUANTITIES), (to_price, PRICES),
], ids=["parse_date", "to_int", "to_qty", "to_price"])
def test_cells(spark, function, golden):
    assert dict(zip(golden, evaluate(spark, function, golden))) == golden


def test_ratio_rounds_once_and_guards_zero(spark):
    pairs = [("2", "3"), ("1", "3"), ("-1", "3"), ("1", "0"), ("1", None), ("0.01", "20000"),
             ("0.99", "20000")]
    frame = spark.createDataFrame([(D(a), D(b) if b else None) for a, b in pairs],
                                  "num decimal(18,2), den decimal(18,2)")
    found = [r[0] for r in frame.selectExpr(safe_ratio("num", "den", 4)).collect()]
    # 0.99 / 20000 = 0.0000495, where rounding at six digits first would give 0.00005 -> 0.0001.
    assert found == [D("0.6667"), D("0.3333"), D("-0.3333"), None, None, D("0.0000"), D("0.0000")]
    huge = spark.range(1).selectExpr(safe_ratio("123456789012345.67BD", "0.01BD", 4))
    with pytest.raises(Exception, match="out of range"):
        huge.collect()
    keys = spark.createDataFrame([(202401,), (202402,)], "k int")
    assert [r[0] for r in keys.selectExpr(previous_month_key("k")).collect()] == [202312, 202401]


def staged(spark, feed, *lines):
    data = [(i + 1, "f.csv", *line.split(";")) for i, line in enumerate(lines)]
    cells = ", ".join(f"{c} string" for c in FEED_COLUMNS[feed])
    return spark.createDataFrame(data, f"load_id long, file_name string, {cells}")


PERIOD = "01.05.2024;01.04.2024;30.04.2024"


@pytest.mark.parametrize("feed, line, reason", [
    ("turnover", f"{PERIOD};0101;90;кг;10;5;-3;12.001", None),
    ("turnover", f"{PERIOD};0101;90;кг;10;5;-3;12.002", "Несоответствие остатков и движений"),
    ("turnover", f"{PERIOD};0101;x;кг;10;5;-3;12", "Некорректный material_id; Пустой material_id"),
    ("turnover", f"{PERIOD};0101;90;кг;10;5;3;18", "expense_qty > 0"),
    ("turnover", f"{PERIOD}; ;0; ;-1;-1;0;-2",
     "Пустой warehouse_code; Пустой unit; material_id <= 0; income_qty < 0; balance_start < 0; "
     "balance_end < 0"),
    ("prices", "01.05.2024;30.04.2024;01.04.2024;90;0", "start_date > end_date; price <= 0"),
    ("prices", f"{PERIOD};90;12,5", "Некорректный price"),
    ("warehouses", f"{PERIOD};0101;A;MAIN;North;;keeper", None),
    ("warehouses", f"{PERIOD};0101;A;MAIN;North;abc;", "Некорректный mol_id"),
    ("warehouses", f"{PERIOD}; ;A;;North;0;", "Пустой warehouse_code; Пустой warehouse_type; mol_id <= 0"),
    ("warehouses", "x;;1e3;0101;A;MAIN;North;4;",
     "Некорректная date; Некорректная start_date; Некорректная end_date"),
])
def test_rules(spark, feed, line, reason):
    checked = rules.with_reason(clean(staged(spark, feed, line), feed), feed)
    assert checked.first()["error_reason"] == reason


def test_hot_key_duplicates_without_grouping_rows(spark):
    """A third of all rows has one key; only the first of them stays, also across loads."""
    frame = spark.range(3000).selectExpr(
        "id AS load_id", "DATE'2024-05-01' AS date", "if(id % 3 = 0, 7, int(id)) AS material_id",
        "DATE'2024-04-01' AS start_date", "DATE'2024-04-30' AS end_date",
        "cast(NULL AS string) AS error_reason",
    )
    flagged = dedup.flag_duplicates(frame, "prices")
    assert flagged.count() == 3000
    # id 7 itself has key 7 as well, but id 0 came first.
    assert flagged.filter("error_reason IS NULL").count() == 2000
    stored = frame.filter("load_id = 1").select("load_id", *dedup.BUSINESS_KEYS["prices"])

    def known(some):
        return stored.join(some, dedup.BUSINESS_KEYS["prices"], "left_semi").drop("load_id")

    later = dedup.flag_duplicates(frame.filter("load_id > 5"), "prices", known)
    assert later.filter("error_reason IS NULL AND load_id = 6").count() == 1
    again = frame.filter("load_id = 1").withColumn("load_id", F.lit(9000).cast("long"))
    assert rows(dedup.flag_duplicates(again, "prices", known), "error_reason") == [(rules.DUPLICATE,)]


def test_latest_export_wins(spark):
    schema = "load_id long, date date, start_date date, end_date date, material_id int, price decimal(18,2)"
    prices = spark.createDataFrame([
        (1, date(2024, 5, 1), *APRIL, 4, D(33)), (2, date(2024, 5, 17), *APRIL, 4, D(33)),
        (3, date(2024, 5, 20), *APRIL, 4, D(35)), (4, date(2024, 5, 20), *APRIL, 5, D(1)),
        (5, date(2024, 5, 20), *APRIL, 5, D(2)),
    ], schema)
    assert rows(facts.latest_prices(prices), "material_id", "date", "price") == [
        (4, date(2024, 5, 20), D("35.00")), (5, date(2024, 5, 20), D("2.00")),
    ]


REGISTRY = ("load_id long, date date, warehouse_code string, shop_code string, warehouse_type string, "
            "directorate string, mol_id int, mol_position string")


def registry(spark, *lines):
    data = [(i, d, code, shop, "MAIN", None, mol, None) for i, (code, d, shop, mol) in enumerate(lines)]
    return spark.createDataFrame(data, REGISTRY)


def build(frame):
    return wh.build_versions(wh.changes(wh.snapshots(frame)))


def test_versions(spark):
    history = registry(
        spark,
        ("S022", date(2024, 1, 1), None, 4), ("S022", date(2024, 2, 1), "", 4),
        ("S022", date(2025, 3, 1), "", 186), ("S022", date(2025, 3, 1), "second of the day", 1),
    )
    versions = build(history)
    assert rows(versions, "date_from", "date_to", "mol_id", "is_current") == [
        (date(2024, 1, 1), date(2025, 2, 28), 4, False),
        (date(2025, 3, 1), date(9999, 12, 31), 186, True),
    ]
    back = registry(spark, ("X", date(2024, 1, 1), "A", 1), ("X", date(2024, 2, 1), "B", 1),
                    ("X", date(2024, 3, 1), "A", 1))
    assert build(back).count() == 3
    # The same history in two loads: the last change equals the current version, nothing moves.
    stored = build(back.filter("load_id = 0"))
    assert wh.pending_changes(stored, wh.changes(wh.snapshots(back))).count() == 0
    # Older snapshots that arrive late are ignored; a new code is let in only if not strict.
    late = registry(spark, ("X", date(2023, 1, 1), "Z", 1), ("N", date(2024, 1, 1), "A", 1))
    changed = wh.changes(wh.snapshots(late))
    assert wh.pending_changes(stored, changed).count() == 0
    assert rows(wh.pending_changes(stored, changed, strict=False), "warehouse_code") == [("N",)]
    assert quality.broken_versions(versions).count() == 0
    # A long version reaches over the next one into the one after it.
    long = spark.createDataFrame([
        ("A", date(2024, 1, 1), date(2024, 12, 31), False), ("A", date(2024, 2, 1), date(2024, 2, 10), False),
        ("A", date(2024, 6, 1), date(9999, 12, 31), True),
    ], "warehouse_code string, date_from date, date_to date, is_current boolean")
    assert rows(quality.broken_versions(long), "date_from", "problem") == [
        (date(2024, 2, 1), "overlap"), (date(2024, 6, 1), "overlap")]


@pytest.fixture(params=["10m", "1", "-1"])
def broadcast_limit(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def valid_on(versions, code, day):
    """The version of the code that began last among those valid on the day, by a plain search."""
    begun = [v for v in versions if v[0] == code and code is not None and v[1] <= day]
    last = max(begun, key=lambda v: v[1:3], default=None)
    return last[3] if last and last[2] >= day else None


def test_as_of_equals_search_with_and_without_broadcast(spark, broadcast_limit):
    """Hot code, hot day, codes and days that are null or unknown, overlaps, holes, repeated rows."""
    draw = random.Random(broadcast_limit)
    first = date(2024, 1, 1)
    versions, sk = [], 0
    for code in ["hot", *map(str, range(40))]:
        day = first
        for _ in range(draw.randint(1, 12)):
            sk += 1
            day += timedelta(days=draw.randint(1, 30))
            versions.append((code, day, day + timedelta(days=draw.randint(0, 40)), sk))
    asked = [("hot", first + timedelta(days=draw.randint(0, 400)), i) for i in range(1500)]
    asked += [("hot", date(2024, 6, 1), -i) for i in range(800)] + [("hot", None, -900), (None, first, -901)]
    asked += [(str(draw.randint(0, 45)), first + timedelta(days=draw.randint(-9, 400)), 5000 + i) for i in range(900)]
    asked += asked[:3]
    table = spark.createDataFrame(versions, "code string, date_from date, date_to date, sk int")
    probe = spark.createDataFrame(asked, "code string, day date, i int")
    found = asof.as_of(probe, asof.disjoint(table, "code"), "code", "day")
    assert found.columns == ["code", "day", "i", "sk"]
    wanted = [(*a, valid_on(versions, *a[:2]) if a[1] else None) for a in asked]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))
    assert asof.as_of(probe.limit(0), asof.disjoint(table, "code"), "code", "day").count() == 0
    assert asof.as_of(probe, asof.disjoint(table.limit(0), "code"), "code", "day").filter("sk IS NOT NULL").count() == 0


def test_version_on_export_date_or_current(spark):
    versions = build(registry(spark, ("A", date(2024, 2, 1), "x", 1), ("A", date(2024, 3, 1), "y", 1)))
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 1)]
    sales = spark.createDataFrame(
        [("A", d, i) for i, d in enumerate(days)] + [("B", days[0], 9)],
        "warehouse_code string, date date, material_id int",
    )
    shops = versions.select("warehouse_sk", "shop_code")

    def resolved(function):
        return [r.shop_code for r in function(sales, versions).join(shops, "warehouse_sk", "left")
                .orderBy("material_id").collect()]

    assert resolved(wh.version_on_date) == [None, "x", "x", "y", None]
    assert resolved(wh.resolve_version) == ["y", "x", "x", "y", None]
    # A hole between versions and after the last one also falls back to the current version.
    gappy = spark.createDataFrame([
        ("A", 1, date(2024, 1, 1), date(2024, 1, 10), False),
        ("A", 2, date(2024, 2, 1), date(2024, 2, 10), True),
    ], "warehouse_code string, warehouse_sk long, date_from date, date_to date, is_current boolean")
    probe = spark.createDataFrame(
        [("A", date(2024, 1, 5), 1), ("A", date(2024, 1, 20), 2), ("A", date(2025, 1, 1), 3)],
        "warehouse_code string, date date, material_id int")
    assert rows(wh.resolve_version(probe, gappy), "material_id", "warehouse_sk") == [(1, 1), (2, 2), (3, 2)]


def test_unit_overwrite_and_upsert(spark):
    stored = spark.createDataFrame([(1, "кг"), (2, "м"), (3, None)], "material_id int, unit string")
    master = spark.createDataFrame([(1, "шт"), (2, None), (4, "м")], "material_id int, unit string")
    assert rows(merge_materials(stored, master), "material_id", "unit") == [
        (1, "шт"), (2, "м"), (3, None), (4, "м")]
    old = spark.createDataFrame([(1, D(1)), (2, D(2)), (3, None)], "k int, v decimal(18,2)")
    new = spark.createDataFrame([(1, D(5)), (3, D(0)), (4, D(4))], "k int, v decimal(18,2)")
    assert rows(merge.upsert(old, new, ["k"], ["v"], "0")) == [
        (1, D("5.00"), "update"), (2, D("2.00"), "keep"), (3, None, "keep"), (4, D("4.00"), "insert")]


def test_folded_codes(spark):
    columns = ["load_id", "file_name", *FEED_COLUMNS["warehouses"]]
    data = [(i, "f", "1", "1", "1", code, "a", "b", "c", "1", "p") for i, code in enumerate(["115h", "115H ", " 115H"])]
    staged = spark.createDataFrame(data, "load_id long, file_name string, " + ", ".join(f"{c} string" for c in columns[2:]))
    assert rows(clean(staged, "warehouses", fold_codes=True).select("warehouse_code").distinct()) == [("115H",)]
    assert clean(staged, "warehouses").select("warehouse_code").distinct().count() == 2


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 1461
    saturday = days.filter("full_date = DATE'2024-01-06'").first()
    assert (saturday.date_key, saturday.day_of_week, saturday.is_weekend, saturday.month_name) == (
        20240106, 6, True, "Январь")
    with pytest.raises(ValueError):
        dim_date(spark, date(2024, 1, 2), date(2024, 1, 1))
    # No length is refused; a long calendar is joined like any table.
    assert dim_date(spark, date(1, 1, 1), date(9999, 1, 1)).count() == 3_651_695
    frame = spark.createDataFrame([(date(2022, 12, 1), date(2022, 12, 31)), APRIL],
                                  "start_date date, end_date date")
    assert with_date_keys(frame, days).count() == 1
    assert outside_calendar(frame, days).count() == 1


def monthly(spark, *slices):
    """(month_key, directorate, shop, warehouse, stock, average, expense)"""
    data = [(m, m // 100, m % 100, d, s, w, "MAIN", *[None if v is None else D(v) for v in money])
            for m, d, s, w, *money in slices]
    return spark.createDataFrame(
        data, "month_key int, year_num int, month_num int, directorate string, shop_code string, "
        "warehouse_code string, warehouse_type string, stock_value decimal(18,2), "
        "avg_stock_value decimal(18,2), expense_value decimal(18,2)")


def test_metrics(spark):
    mart = monthly(
        spark,
        (202312, "N", "A", "1", 10, 25, 10), (202401, "N", "A", "1", 15, 0, 10),
        (202401, "N", "B", "2", 15, 100, None), (202403, "N", "A", "1", 1, 1, 1),
    )
    days = dim_date(spark)
    metrics = marts.turnover_metrics(mart, days)
    company = metrics.filter("agg_level = 'company'")
    assert rows(company, "month_key", "turnover_ratio", "turnover_days", "mom_stock_value") == [
        (202312, D("0.4000"), D("75.00"), None),
        (202401, D("0.1000"), D("300.00"), D("2.0000")),
        (202403, D("1.0000"), D("30.00"), None),  # the month before is missing
    ]
    own = metrics.filter("agg_level = 'warehouse' AND month_key = 202401")
    assert rows(own, "agg_key", "turnover_ratio", "turnover_days") == [
        ("1", None, D("0.00")), ("2", None, None)]
    assert rows(metrics.filter("agg_level = 'shop'"), "agg_key")[0] == ("N | A",)
    # Sums agree between the levels.
    per_level = metrics.groupBy("agg_level").agg(F.sum("stock_value").alias("s"))
    assert {r.s for r in per_level.collect()} == {D("41.00")}
    assert marts.role_slice(metrics, "shop_head", ["B"]).count() == 1
    assert marts.role_slice(metrics, "general_director").count() == 3
    readers = spark.createDataFrame(
        [("all", "shop", None), ("one", "warehouse", "2")], "reader string, agg_level string, zone string")
    seen = marts.entitled_slices(metrics, readers).groupBy("reader").count()
    assert rows(seen) == [("one", 1)]  # who has no zone reads the level itself
    assert marts.whole_level(metrics, "shop").count() == 4


def test_reports(spark):
    broken = spark.createDataFrame([("a; b",), ("a",), ("a; b",)], "error_reason string")
    assert rows(reports.quarantine_reasons(broken), "reason", "n_rows") == [("a", 3), ("b", 2)]
    with pytest.raises(ValueError):
        feed_columns("invoices")


def test_files_round_trip(spark, tmp_path):
    folder = tmp_path / "Склады +1"
    folder.mkdir()
    lines = [f'45413;{i};"a ""q""; b";90;{i}.5' for i in range(500)]
    (folder / "p.csv").write_bytes(("\n".join(["h;e;a;d;r", *lines]) + "\n").encode("utf-16"))
    listed = files.list_files(spark, f"file://{folder}")
    assert listed.count() == 1
    path = listed.first().path
    whole = delimited.scan(spark, "prices", [path], "UTF-16", splittable=False, positions=True)
    whole.write.parquet(f"file://{tmp_path}/whole")
    scanned = delimited.with_load_id(spark.read.parquet(f"file://{tmp_path}/whole"), 41)
    found = scanned.orderBy("load_id").collect()
    assert [r.start_date for r in found] == [str(i) for i in range(500)]
    assert (found[0].load_id, found[0].end_date, found[0].file_name) == (42, 'a "q"; b', path)
    out = f"file://{tmp_path}/out"
    delimited.export(scanned, "prices", out)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        for splittable in (False, True):
            again = delimited.scan(spark, "prices", out, splittable=splittable)
            assert again.drop("file_name").exceptAll(scanned.select(*raw_schema("prices").names)).count() == 0
            assert again.count() == 500
        # Several files of unlike size: numbered by path, block and row, without gaps.
        one = f"file://{tmp_path}/one"
        delimited.export(scanned.orderBy("load_id").limit(20).coalesce(1), "prices", f"{one}/b")
        delimited.export(scanned.orderBy("load_id").coalesce(1), "prices", f"{one}/a")
        both = delimited.scan(spark, "prices", [f"{one}/b", f"{one}/a"], positions=True)
        assert both.rdd.getNumPartitions() > 1
        both.write.parquet(f"file://{tmp_path}/both")
        split = delimited.with_load_id(spark.read.parquet(f"file://{tmp_path}/both"))
        found = split.orderBy("load_id").collect()
        assert [r.load_id for r in found] == list(range(520))
        assert [r.start_date for r in found] == [str(i) for i in range(500)] + [str(i) for i in range(20)]
        # Large files have a fingerprint that does not depend on how they are cut.
        registry = spark.createDataFrame([], REGISTRY_SCHEMA)
        delivered = files.list_files(spark, f"{one}/a")
        prints = files.fingerprint_delivered(delivered, registry, large=1000).first()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        assert files.fingerprint_delivered(delivered, registry, large=1000).first() == prints
        assert len(prints.file_hash) == 64 and prints.file_size_bytes > 1000
        # A file whose size and time are known is not read again.
        known = spark.createDataFrame(
            [("p", "f", prints.file_path, "stored", prints.file_size_bytes, "loaded", 1, None, None, prints.modified_at)],
            REGISTRY_SCHEMA)
        again = files.fingerprint_delivered(delivered, known)
        assert [r.file_hash for r in again.collect()] == ["stored"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_digest_for_files_of_any_size(spark, tmp_path):
    """Whole or in pieces, whatever the bytes; and other orders of lines are other files."""
    import hashlib

    lines = [b"%d;" % i + b"x" * (i % 7) for i in range(3000)]
    contents = {
        "feed": b"\n", "feeds": b"\n\n\n", "open": b"a\n\nb", "closed": b"a\n\nb\n", "crlf": b"a\r\nb\r\n",
        "wild": bytes(range(256)) * 40, "utf16": "a;Њ\nб\n".encode("utf-16"), "mark": b"\xef\xbb\xbfa\nb",
        "lines": b"\n".join(lines), "turned": b"\n".join(lines[::-1]),
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)

    def plain(content):
        cut = content.removeprefix(b"\xef\xbb\xbf").split(b"\n")
        cut = cut[:-1] if cut[-1] == b"" else cut
        digests = [hashlib.sha256(line).hexdigest() for line in cut]
        blocks = [hashlib.sha256("".join(digests[i : i + 64]).encode()).hexdigest() for i in range(0, len(digests), 64)]
        return hashlib.sha256(f"{len(content)}|{len(digests)}|{''.join(blocks)}".encode()).hexdigest()

    wanted = sorted((name, plain(content), len(content)) for name, content in contents.items())
    assert len({digest for _, digest, _ in wanted}) == len(contents)
    found = files.list_files(spark, f"file://{tmp_path}", "*")
    for limit in ("1000", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            for prints in (files.fingerprint(found, 64), files.fingerprint_large(found, block_lines=64)):
                got = sorted((r.file_path.rsplit("/", 1)[-1], r.file_hash, r.file_size_bytes) for r in prints.collect())
                assert got == wanted
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stale_outputs(spark, tmp_path):
    for name, stamp in (("in/a.dat", 100), ("in/b.dat", 300), ("in/c.dat", 100),
                        ("out/a.csv", 200), ("out/b.csv", 200)):
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_text("x")
        os.utime(file, (stamp, stamp))
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    stale = files.stale_outputs(files.list_files(spark, source, "*.dat"),
                                files.list_files(spark, target), source, target)
    assert rows(stale, "stem") == [("b",), ("c",)]


@pytest.mark.parametrize("feed", ["turnover", "prices", "warehouses"])
def test_conversion_stays_small_enough_to_be_compiled(spark, tmp_path, feed):
    """The JVM interprets methods of more than 8000 bytes, which costs several times as much per row."""
    staged = spark.createDataFrame(
        [(1, "f.csv", *["1"] * len(FEED_COLUMNS[feed]))],
        f"load_id long, file_name string, {', '.join(f'{c} string' for c in FEED_COLUMNS[feed])}",
    )
    staged.write.parquet(f"{tmp_path}/staged")
    clean(spark.read.parquet(f"{tmp_path}/staged"), feed).createOrReplaceTempView("cleaned")
    plan = spark.sql("EXPLAIN CODEGEN SELECT * FROM cleaned").first()[0]
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < 8000


def test_month_price_equals_period_price_without_another_shuffle(spark, tmp_path):
    """Several periods begin in a month; some facts have no price, some no date of the calendar."""
    calendar = dim_date(spark, date(2024, 1, 1), date(2024, 2, 29))
    periods = [(20240101, 20240131), (20240101, 20240115), (20240116, 20240131), (20240201, 20240229), (20230101, None)]
    facts_of = [(s, e, m, f"w{w}", w) for s, e in periods for m in (1, 2, None) for w in range(3)]
    facts_of = spark.createDataFrame(
        facts_of, "date_key_start int, date_key_end int, material_sk long, warehouse_code string, n int"
    )
    prices = spark.createDataFrame(
        [(s, e, m, D(s % 1000 + (e or 0) % 100 + m)) for s, e in periods[1:] for m in (1, 3)],
        "date_key_start int, date_key_end int, material_sk long, price decimal(18,2)",
    )
    dated = marts.with_month(facts_of, calendar)
    found = marts.with_month_price(dated, prices, calendar)
    expected = marts.with_price(dated, prices).select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.filter("price IS NOT NULL").count() == 9
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summed = found.groupBy(*marts.MONTHLY_GROUP).agg(F.max("price"))
        plan = summed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_steps_leave_neither_shuffles_nor_work_folders(spark, tmp_path):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        files_now = manager.getAllFiles()
        names = (files_now.apply(i).getName() for i in range(files_now.size()))
        return {n for n in names if n.startswith("shuffle_")}

    layers, before = Layers(spark, f"{tmp_path}/state"), shuffles()
    with brief_shuffles(spark):
        layers.stage("counted", spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
        for _ in range(50):
            if not shuffles() - before:
                break
            time.sleep(0.2)
        assert not shuffles() - before
    assert spark.conf.get(BRIEF_SHUFFLES) == "false"
    layers.unstage("counted", "never_written")
    assert not os.path.exists(f"{tmp_path}/state/work/counted/batch=1")
