"""The whole load over delivered files: first load, reruns, corrections, later registry."""

from datetime import date
from decimal import Decimal

import pytest

from saldo.operators.calendar import dim_date
from saldo.plans import marts, nightly
from saldo.plans.nightly import Options, run_nightly
from saldo.sources.delimited import scan
from saldo.sources import layers as layers_module
from saldo.streaming import landing as stream
from saldo.sources.layers import NEWEST, SUM, Layers, Merge

HEADERS = {
    "turnover": "d;s;e;w;m;u;bs;i;x;be",
    "prices": "d;s;e;m;p",
    "warehouses": "d;s;e;w;shop;type;dir;mol;pos",
}
APRIL = "01.04.2024;30.04.2024"
MAY = "01.05.2024;31.05.2024"


@pytest.fixture(autouse=True, scope="module")
def light_plans(spark):
    """Handfuls of rows: compiling a class per stage would cost more than running it."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


class Landing:
    def __init__(self, root):
        self.root = root
        for feed in HEADERS:
            (root / feed).mkdir()

    def put(self, feed, name, *lines):
        text = "\n".join([HEADERS[feed], *lines]) + "\n"
        (self.root / feed / name).write_bytes(text.encode("utf-16"))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    root.mkdir()
    return Landing(root)


@pytest.fixture
def state(tmp_path):
    return f"file://{tmp_path}/state"


def load(spark, landing, state, **options):
    return run_nightly(spark, f"file://{landing.root}", state, Options(**options))


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def first_delivery(landing):
    landing.put(
        "warehouses", "registry.csv",
        "45292;45292;45322;0101;A;MAIN;North;4;keeper",
        "45292;45292;45322;0102;A;MAIN;North;;",
    )
    landing.put("prices", "p.csv", f"45413.0;{APRIL};90;2", f"45413;{APRIL};91;10")
    landing.put(
        "turnover", "t.csv",
        f"01.05.2024;{APRIL};0101;90;кг;10;10;-5;15",
        f"01.05.2024;{APRIL};0102;91;шт;1;0;0;1",
        f"01.05.2024;{APRIL};115H;90;кг;2;0;-1;1",
        f"01.05.2024;{APRIL};0101;90;кг;7;0;0;7",
        f"01.05.2024;{APRIL};0101;x;кг;7;0;0;7",
    )


def check_first_load(layers):
    assert layers.batch == 2  # one commit for the pending files, one for the load
    assert layers.read("staging/turnover").count() == 5
    assert layers.read("ods/turnover").count() == 3
    assert rows(layers.read("quarantine/turnover"), "error_reason", "material_id") == [
        ("Дубликат строки в staging", "90"),
        ("Некорректный material_id; Пустой material_id", "x"),
    ]
    monthly = layers.read("datamart/inventory_monthly").filter("warehouse_code = '0101'")
    assert rows(monthly, "month_key", "avg_qty", "stock_value", "avg_stock_value", "expense_value") == [
        (202404, Decimal("12.50"), Decimal("30.00"), Decimal("25.00"), Decimal("10.00"))
    ]
    metrics = layers.read("datamart/turnover_metrics")
    own = metrics.filter("agg_level = 'warehouse' AND agg_key = '0101'")
    assert rows(own, "month_name", "turnover_ratio", "turnover_days") == [
        ("Апрель", Decimal("0.4000"), Decimal("75.00"))
    ]
    unknown = metrics.filter("agg_level = 'shop' AND directorate = 'Не определена'")
    assert rows(unknown, "agg_key") == [("Не определена | —",)]
    # Text files and nested folders were there too.
    assert rows(layers.read("elt/file_registry"), "source_type", "file_name", "status", "rows_loaded") == [
        ("prices", "p.csv", "loaded", 2), ("turnover", "t.csv", "loaded", 5),
        ("warehouses", "registry.csv", "loaded", 2),
    ]


def check_failed_load(spark, state):
    layers = Layers(spark, state)
    assert layers.batch == 4  # pending, then failed
    steps = layers.read("elt/run_steps").filter("status = 'failed'")
    assert rows(steps, "step", "n_rows") == [("stage turnover", None)]
    assert layers.read("staging/turnover").count() == 5
    failed = layers.read("elt/file_registry").filter("status = 'failed'")
    assert rows(failed, "file_name", "error_message") == [("t2.csv", "unreadable")]


def check_reports(layers):
    counts = {(r.layer, r.feed): r.n_rows for r in layers.read("elt/layer_counts").filter("n_rows > 0").collect()}
    assert counts["staging", "turnover"] == 5 and counts["dwh", "fact_inventory"] == 3
    assert counts["datamart", "inventory_monthly"] == 3
    assert rows(layers.read("elt/quarantine_reasons"), "feed", "reason", "n_rows") == [
        ("turnover", "Дубликат строки в staging", 1), ("turnover", "Некорректный material_id", 1),
        ("turnover", "Пустой material_id", 1)]
    assert rows(layers.read("elt/lost_rows"), "lookup", "n_rows") == [("calendar", 0), ("material", 0)]
    assert layers.read("elt/broken_constraints").filter("n_rows > 0").count() == 0
    steps = {r.step: (r.status, r.n_rows) for r in layers.read("elt/run_steps").collect()}
    assert steps["stage turnover"] == ("done", 5) and steps["validate turnover"] == ("done", 3)
    assert steps["marts"] == ("done", None)


def check_second_load(layers):
    assert layers.read("elt/file_registry").filter("status <> 'loaded'").count() == 0
    repeated = layers.read("quarantine/turnover").filter("file_name LIKE '%t2.csv'")
    assert rows(repeated, "error_reason", "balance_start") == [("Дубликат строки в staging", "99")]
    versions = layers.read("dwh/dim_warehouse")
    assert rows(versions.filter("warehouse_code = '115H'"), "date_from", "date_to", "shop_code", "is_current") == [
        (date(1900, 1, 1), date(2024, 4, 30), "—", False),
        (date(2024, 5, 1), date(9999, 12, 31), "B", True),
    ]
    # A code that is new to registry and turnover alike only has its placeholder so far.
    assert rows(versions.filter("warehouse_code = '0200'"), "warehouse_type") == [("UNKNOWN",)]
    facts = layers.read("dwh/fact_inventory")
    # The later export of 0101 replaced its fact; the export of 115H on 1 May now resolves to the
    # new version, and its old fact stays.
    assert rows(facts.join(versions, "warehouse_sk"), "warehouse_code", "date_from", "balance_start") == [
        ("0101", date(2024, 1, 1), Decimal("20.00")),
        ("0102", date(2024, 1, 1), Decimal("1.00")),
        ("0200", date(1900, 1, 1), Decimal("15.00")),
        ("115H", date(1900, 1, 1), Decimal("2.00")),
        ("115H", date(2024, 5, 1), Decimal("2.00")),
    ]
    company = layers.read("datamart/turnover_metrics").filter("agg_level = 'company'")
    # No price for May: the measures are null and so is the change.
    assert rows(company.filter("month_key = 202405"), "stock_value", "mom_stock_value") == [(None, None)]


def test_load_that_dies_and_state_that_is_lost(spark, landing, state, tmp_path, monkeypatch):
    first_delivery(landing)

    def killed(*_args, **_options):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(nightly, "validate_feed", killed)
        with pytest.raises(KeyboardInterrupt):
            load(spark, landing, state)
    registry = Layers(spark, state).read("elt/file_registry")
    assert rows(registry, "source_type", "status") == [
        ("prices", "pending"), ("turnover", "pending"), ("warehouses", "pending")]
    layers = load(spark, landing, state)
    assert layers.read("ods/turnover").count() == 3
    assert layers.read("elt/file_registry").filter("status <> 'loaded'").count() == 0
    # Tables without commit records are an error, not an empty start, and nothing is written.
    commits = tmp_path / "state" / "commits"
    commits.rename(tmp_path / "elsewhere")
    before = sorted(str(p) for p in (tmp_path / "state").rglob("*.parquet"))
    with pytest.raises(RuntimeError):
        load(spark, landing, state)
    commits.mkdir()
    with pytest.raises(RuntimeError):
        load(spark, landing, state)
    assert sorted(str(p) for p in (tmp_path / "state").rglob("*.parquet")) == before


def test_only_touched_months_are_written(spark, landing, state):
    first_delivery(landing)
    first = load(spark, landing, state)
    landing.put("turnover", "t2.csv", f"01.06.2024;{MAY};0101;90;кг;15;0;-3;12")
    second = load(spark, landing, state)
    april, may = [202404], [202405]

    def stored(layers, table, month):
        return {layers.folders[table][p] for p in layers.parts(table, month)}

    # The clean layer of April was not touched, nor is it read for rows of May.
    assert second.parts("ods/turnover", [202404]) == first.parts("ods/turnover", [202404])
    read = second.read("ods/turnover", second.parts("ods/turnover", [202405]))
    assert all("start_month=202405" in f for f in read.inputFiles())
    for table in ("dwh/fact_inventory", "datamart/inventory_monthly", "datamart/turnover_metrics"):
        assert stored(second, table, april) == stored(first, table, april) != set(), table
        assert set(second.folders[table]) == set(second.parts(table, april + may))
    # A unit that changes brings the months of its material back, and the month after each.
    landing.put("turnover", "t3.csv", f"02.06.2024;{MAY};0102;91;ящ;15;0;-3;12")
    third = load(spark, landing, state)
    for table in ("datamart/inventory_monthly", "datamart/turnover_metrics"):
        assert stored(third, table, april) != stored(second, table, april), table
    assert rows(third.read("datamart/inventory_monthly").filter("material_id = 91"), "month_key", "unit") == [
        (202404, "ящ"), (202405, "ящ")]
    assert rows(third.read("dwh/dim_date").selectExpr("min(full_date) AS a", "max(full_date) AS b"), "a", "b") == [
        (date(2024, 1, 1), date(2024, 12, 31))]


def test_story_of_several_nights(spark, landing, state, tmp_path, monkeypatch):
    empty = Layers(spark, state)
    assert (empty.batch, empty.folders) == (0, {})
    first_delivery(landing)
    (landing.root / "turnover" / "note.txt").write_text("x")
    (landing.root / "turnover" / "old").mkdir()
    (landing.root / "turnover" / "old" / "t9.csv").write_bytes("h\n".encode("utf-16"))
    layers = load(spark, landing, state)
    check_first_load(layers)
    check_reports(layers)

    assert load(spark, landing, state).batch == 2  # nothing new, nothing done

    landing.put(
        "turnover", "t2.csv",
        f"01.05.2024;{APRIL};0101;90;кг;99;0;0;99",  # same key again: quarantined
        f"17.05.2024;{APRIL};0101;90;кг;20;0;-5;15",  # later export of the period: wins
        f"01.06.2024;{MAY};0200;91;шт;15;0;0;15",
    )
    landing.put(
        "warehouses", "r2.csv",
        "01.05.2024;01.05.2024;31.05.2024;115H;B;MAIN;South;7;",
        "01.05.2024;01.05.2024;31.05.2024;0200;B;MAIN;South;7;",
    )
    with monkeypatch.context() as patch:
        def broken(_spark, feed, *_args, **_options):
            if feed == "turnover":
                raise RuntimeError("unreadable")
            return scan(_spark, feed, *_args, **_options)

        patch.setattr(nightly, "scan", broken)
        with pytest.raises(RuntimeError):
            load(spark, landing, state)
    check_failed_load(spark, state)

    died = set(tmp_path.glob("state/staging/turnover/batch=*"))
    layers = load(spark, landing, state)
    check_second_load(layers)
    # Folders of the load that died are gone, and so is all scratch of loads that no reader follows.
    named = {f for parts in layers.folders.values() for f in parts.values()}
    assert len(list(tmp_path.glob("state/staging/warehouses/batch=*"))) == 2 and died
    assert {p.name for p in tmp_path.glob("state/staging/turnover/batch=*")} == {
        f.rsplit("/", 1)[-1] for f in named if "/staging/turnover/" in f}

    # Without any new file the next run upgrades the placeholder, and then there is nothing left.
    layers = load(spark, landing, state)
    mine = layers.read("dwh/dim_warehouse").filter("warehouse_code = '0200'")
    assert rows(mine, "warehouse_type", "is_current") == [("MAIN", True), ("UNKNOWN", False)]
    assert load(spark, landing, state).batch == layers.batch


def test_two_loads_equal_one(spark, landing, state, tmp_path):
    first_delivery(landing)
    load(spark, landing, state)
    landing.put("prices", "p2.csv", f"17.05.2024;{APRIL};90;3", f"01.06.2024;{MAY};90;4")
    landing.put("turnover", "t2.csv", f"01.06.2024;{MAY};0101;90;шт;15;0;-3;12")  # another unit, too
    two = load(spark, landing, state)
    one = load(spark, landing, f"file://{tmp_path}/other")
    for table in ("datamart/turnover_metrics", "datamart/inventory_monthly", "dwh/fact_prices",
                  "dwh/fact_inventory", "dwh/dim_material", "dwh/dim_warehouse"):
        columns = one.read(table).columns
        assert as_text(two.read(table), columns) == as_text(one.read(table), columns), table


def test_many_small_loads_equal_one(spark, landing, state, tmp_path, monkeypatch):
    """Later exports, lower prices, a price taken over by none, a version that comes late, compaction."""
    monkeypatch.setattr(layers_module, "COMPACT_FOLDERS", 2)
    first_delivery(landing)
    load(spark, landing, state)
    landing.put("prices", "p2.csv", f"17.05.2024;{APRIL};90;1", f"17.05.2024;{APRIL};92;5")  # lower than before
    landing.put("turnover", "t2.csv", f"17.05.2024;{APRIL};0101;92;л;4;0;0;4", f"17.05.2024;{APRIL};115H;90;кг;9;0;-9;0")
    two = load(spark, landing, state)
    group = two.read("datamart/inventory_monthly").filter("warehouse_code = '0101' AND material_id = 90")
    assert rows(group, "price", "balance_end") == [(Decimal("1.00"), Decimal("15.00"))]
    landing.put("turnover", "t3.csv", f"20.05.2024;{APRIL};0101;90;кг;0;0;0;0", f"01.06.2024;{MAY};0102;91;шт;1;1;0;2")
    three = load(spark, landing, state)
    # Changes were written next to what was stored, and put together when they grew too many.
    assert any("/compacted/" in f for f in three.folders["dwh/fact_inventory"].values())
    one = load(spark, landing, f"file://{tmp_path}/other")
    for table in ("datamart/turnover_metrics", "datamart/inventory_monthly", "datamart/warehouse_sums",
                  "dwh/fact_prices", "dwh/fact_inventory"):
        columns = one.read(table).columns
        assert as_text(three.read(table), columns) == as_text(one.read(table), columns), table
        if "sums" not in table:
            assert three.numbers[f"rows/{table}"] == three.read(table).count() == one.numbers[f"rows/{table}"], table


def test_one_broken_file_of_three(spark, landing, state, monkeypatch):
    first_delivery(landing)
    landing.put("turnover", "bad.csv", f"01.06.2024;{MAY};0101;90;кг;15;0;-3;12")
    landing.put("turnover", "t3.csv", f"01.06.2024;{MAY};0102;91;шт;15;0;-3;12")

    def broken(_spark, feed, paths, *args, **options):
        if any("bad" in p for p in paths):
            raise RuntimeError("cut off")
        return scan(_spark, feed, paths, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(nightly, "scan", broken)
        with pytest.raises(nightly.FilesFailed, match="bad.csv: cut off"):
            load(spark, landing, state)
    layers = Layers(spark, state)
    registry = layers.read("elt/file_registry").filter("source_type = 'turnover'")
    assert rows(registry, "file_name", "status", "rows_loaded", "error_message") == [
        ("bad.csv", "failed", None, "cut off"), ("t.csv", "loaded", 5, None), ("t3.csv", "loaded", 1, None)]
    assert rows(layers.read("datamart/turnover_metrics").filter("agg_level = 'company'"), "month_key") == [
        (202404,), (202405,)]
    # The next night reads the mended file alone.
    layers = load(spark, landing, state)
    assert layers.read("elt/file_registry").filter("status <> 'loaded'").count() == 0
    assert layers.written("staging/turnover") == 1


def test_stream_loads_each_file_once(spark, landing, state, tmp_path, monkeypatch):
    """One load per micro-batch; runs die before and after the commit of a load."""
    first_delivery(landing)
    landing.put("turnover", "t2.csv", f"01.06.2024;{MAY};0101;90;кг;15;0;-3;12")
    (landing.root / "turnover" / "note.txt").write_text("x")
    place = (spark, f"file://{landing.root}", state, f"file://{tmp_path}/checkpoint")

    def dies(before):
        def run(*args):
            if not before:
                run_nightly(*args)
            raise ValueError("died")

        with monkeypatch.context() as patch:
            patch.setattr(stream, "run_nightly", run)
            with pytest.raises(Exception, match="died"):
                stream.load_stream(*place)

    dies(before=True)
    assert Layers(spark, state).batch == 0
    dies(before=False)
    layers = stream.load_stream(*place)
    assert rows(layers.read("elt/file_registry"), "file_name", "status", "rows_loaded") == [
        ("p.csv", "loaded", 2), ("registry.csv", "loaded", 2), ("t.csv", "loaded", 5), ("t2.csv", "loaded", 1)]
    assert layers.read("staging/turnover").count() == 6
    done = layers.batch
    assert stream.load_stream(*place).batch == done  # nothing new
    landing.put("turnover", "t3.csv", f"01.06.2024;{MAY};0102;91;шт;15;0;-3;12")
    layers = stream.load_stream(*place)
    assert layers.batch > done
    assert layers.read("staging/turnover").count() == 7
    steps = {r.step for r in layers.read("elt/run_steps").collect()}
    assert "take turnover" in steps and not any(s.startswith("decide") for s in steps)


def test_a_failing_step_is_recorded(spark, landing, state, monkeypatch):
    first_delivery(landing)

    def broken(*_args):
        raise RuntimeError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(nightly, "refresh_marts", broken)
        with pytest.raises(RuntimeError, match="no space"):
            load(spark, landing, state)
    layers = Layers(spark, state)
    steps = {r.step: (r.status, r.message) for r in layers.read("elt/run_steps").collect()}
    assert steps["marts"] == ("failed", "no space") and steps["facts"] == ("done", None)
    failed = layers.read("elt/file_registry")
    assert rows(failed, "file_name", "status", "error_message") == [
        (name, "failed", "marts: no space") for name in ("p.csv", "registry.csv", "t.csv")]
    assert not layers.exists("dwh/fact_inventory")
    assert load(spark, landing, state).read("elt/file_registry").filter("status <> 'loaded'").count() == 0


def test_merged_table(spark, tmp_path, monkeypatch):
    """A change writes one small folder; a load that dies in the middle of compaction loses nothing."""
    monkeypatch.setattr(layers_module, "COMPACT_BYTES", 0)
    root = f"file://{tmp_path}/merged"
    merge = Merge(NEWEST, ("k",), "k div 100")
    schema = "k int, v string, _new boolean"

    def change(pairs, commit=True, compact=False):
        layers = Layers(spark, root)
        layers.begin()
        layers.upsert("t", spark.createDataFrame(pairs, schema), merge, "_new")
        done = layers.compact("t") if compact else []
        if commit:
            layers.commit()
            layers.clean_up()
        return layers, done

    change([(k, "a", True) for k in range(300)])
    layers, _ = change([(150, "b", False)])
    assert len(layers.parts("t", [0, 1, 2])) == 4 and layers.numbers["rows/t"] == 300
    written = [p for p in (tmp_path / "merged/t/batch=2").rglob("*.parquet")]
    assert len(written) == 1
    assert spark.read.parquet(f"file://{written[0]}").count() == 1
    _, compacted = change([(k, "c", False) for k in range(100, 200)], commit=False, compact=True)
    assert compacted == ["1"]  # and then the load dies
    stored = {r.k: r.v for r in Layers(spark, root).read("t").collect()}
    assert len(stored) == 300 and stored[150] == "b" and stored[151] == "a"
    layers, compacted = change([(150, "d", False), (999, "e", True)], compact=True)
    for _ in range(3):  # the old folders are gone when no kept record names them
        layers, _ = change([(7, "f", False)])
    stored = {r.k: r.v for r in layers.read("t").collect()}
    assert len(stored) == 301 == layers.numbers["rows/t"] and stored[150] == "d" and stored[7] == "f"
    with pytest.raises(ValueError):
        layers.upsert("t", spark.createDataFrame([(1, "x", True)], schema), Merge(NEWEST, ("v",), "1"))
    sums = Merge(SUM, ("k",), "k div 100")
    for n, v in ((1, 5), (1, 7), (-2, -12)):
        layers.upsert("s", spark.createDataFrame([(1, n, v), (2, 1, 1)], "k int, n long, v long"), sums, "false")
        layers.commit()
    assert rows(Layers(spark, root).read("s"), "k", "n", "v") == [(2, 3, 3)]


def as_text(frame, columns):
    return sorted(str(tuple(r)) for r in frame.select(*columns).collect())


def test_first_rows_of_a_month_meet_nothing(spark, tmp_path):
    """Only in months of earlier loads clean rows are looked up for the batch; the same rows either way."""
    form = "start_date date, end_date date, material_id int, price int, start_month int"
    group = ["start_date", "end_date", "material_id"]

    def bring(day, *rows):
        layers = Layers(spark, f"file://{tmp_path}/state")
        layers.begin()
        batch = layers.append_parts(
            "ods/prices", spark.createDataFrame([(date(2024, m, day), date(2024, m, 28), i, p, 202400 + m)
                                                 for m, i, p in rows], form), "start_month")
        found = nightly._touched(layers, "ods/prices", batch, group)
        layers.commit()
        joins = found._jdf.queryExecution().optimizedPlan().toString().count("Join")
        return joins, sorted((r.start_date.month, r.material_id, r.price) for r in found.collect())

    assert bring(1, (4, 1, 10), (4, 1, 11), (5, 2, 20)) == (0, [(4, 1, 10), (4, 1, 11), (5, 2, 20)])
    assert bring(1, (5, 2, 21), (5, 3, 30), (6, 1, 40)) == (
        1, [(5, 2, 20), (5, 2, 21), (5, 3, 30), (6, 1, 40)])


def test_changes_of_the_mart_meet_each_table_once(spark):
    """Groups with a replaced price forget the old one, others keep the greatest; no join back to the groups."""
    calendar = dim_date(spark, date(2024, 4, 1), date(2024, 4, 30))
    versions = spark.createDataFrame(
        [(1, "w", "N", "S", "M")],
        "warehouse_sk long, warehouse_code string, directorate string, shop_code string, warehouse_type string")
    materials = spark.createDataFrame([(m, m, "u") for m in (7, 8, 9)], nightly.MATERIAL_SCHEMA)
    prices = spark.createDataFrame(
        [(20240401, 20240430, m, Decimal(3)) for m in (7, 8, 9)], nightly.PRICE_SCHEMA)
    change = ", ".join(f"{q}: decimal(18,2)" for q in marts.QUANTITIES)
    new = (Decimal(4), Decimal(2), Decimal(0), Decimal(6))
    facts = spark.createDataFrame(
        [(20240401, 20240430, 1, m, None, new) for m in (7, 9)],
        f"date_key_start int, date_key_end int, warehouse_sk long, material_sk long, old struct<{change}>, "
        f"new struct<{change}>")
    keys = spark.createDataFrame(
        [(20240401, 20240430, 1, 8)] * 2,
        "date_key_start int, date_key_end int, warehouse_sk long, material_sk long")
    effects = marts.change_effects(facts).unionByName(marts.present_effects(keys))
    added = marts.added_monthly(effects, prices, calendar, versions)
    first = marts.changed_monthly(added, None, materials, versions)
    assert rows(first, "material_id", "n_facts", "price", "_was_stored") == [
        (7, 1, Decimal(3), False), (8, 0, Decimal(3), False), (9, 1, Decimal(3), False)]
    joins = first._jdf.queryExecution().optimizedPlan().toString()
    # The calendar twice, versions and their lists, facts and versions, prices, materials, lists.
    assert joins.count("Join") == 7
    stored = first.filter("material_id < 9").selectExpr(
        *[c if c != "price" else "cast(5 AS decimal(18,2)) AS price" for c in marts.STATE_COLUMNS])
    changed = marts.changed_monthly(added, stored, materials, versions)
    assert rows(changed, "material_id", "n_facts", "price", "stock_value", "_was_stored") == [
        (7, 2, Decimal(5), Decimal(60), True), (8, 0, Decimal(3), Decimal(0), True),
        (9, 1, Decimal(3), Decimal(18), False)]
