"""Queries against DuckDB, and the shape of their plans.

By default a part of the queries runs; ALL_QUERIES=1 compares every one, like tools/compare.py.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import __spark_entry__ as contract
from compare import database, difference
from saldo import session
from saldo.catalog.feeds import Feeds
from saldo.catalog.oracle import ORACLE
from saldo.catalog.queries import QUERIES
from saldo.operators import material
from saldo.plans import marts
from saldo.sources import delimited

SOME = ["scan_warehouses", "file_decision", "validate_turnover", "dedup_prices", "ods_new",
        "scd2_close", "scd2_fallback", "upsert_prices", "turnover_metrics", "check_scd2"]
CHOSEN = list(QUERIES) if os.environ.get("ALL_QUERIES") else SOME


@pytest.mark.parametrize("name", CHOSEN)
def test_same_as_duckdb(spark, tables, name):
    assert difference(spark, database(tables), name, tables) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def _plan(frame, capsys):
    frame.explain("formatted")
    return capsys.readouterr().out


def test_facts_are_summed_by_hash(spark, tables, capsys):
    feeds = Feeds(spark, tables)
    monthly = _plan(feeds.monthly, capsys)
    master = _plan(material.material_master(feeds.ods_turnover, feeds.ods_prices), capsys)
    # The mart reads stored layers; nothing above the facts is aggregated by sorting.
    assert "SortAggregate" not in monthly and "HashAggregate" in monthly
    # Text is compared among distinct pairs only.
    assert "HashAggregate" in master
    below = master[master.rindex("== Physical Plan") :].split("SortAggregate")
    assert all("Scan parquet" not in part for part in below[:1])
    stored = feeds.store("monthly", feeds.monthly)
    sums = _plan(marts._pre_aggregate(stored), capsys)
    assert "SortAggregate" not in sums


def test_versions_need_few_shuffles(spark, tables, capsys):
    plan = _plan(contract.queries()["scd2_asof"](spark, tables), capsys)
    tree = plan[: plan.index("\n\n\n")] if "\n\n\n" in plan else plan
    assert tree.count("Exchange") <= 5


@pytest.mark.parametrize("name", ["scd2_asof", "scd2_fallback", "inventory_monthly"])
def test_large_dimension(spark, tables, name, capsys):
    """Without any broadcast by size: the same rows, few shuffles, and each stored table read few times."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert difference(spark, database(tables), name, tables) is None
        plan = _plan(contract.queries()[name](spark, tables), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = plan[: plan.index("\n\n\n")]
    assert tree.count("Exchange") <= 15 and tree.count("Scan parquet") <= 6
    assert "NestedLoop" not in tree and "CartesianProduct" not in tree


@pytest.mark.parametrize("name", ["scd2_fallback", "ods_new", "turnover_metrics", "role_slice"])
def test_plans(spark, tables, name, capsys):
    frame = contract.queries()[name](spark, tables)
    frame.explain("formatted")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def _scratch(spark):
    """Names of the folders that queries keep in the shared folder."""
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


@pytest.fixture
def sent_nothing(spark):
    """Without any broadcast by size, as with large dimensions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marts_drop_the_clean_layer(spark, tables):
    """Once facts and dimensions are stored, the rows they were made of take no disk."""
    before = _scratch(spark)
    contract.queries()["turnover_metrics"](spark, tables).count()
    left = {name.rsplit("-", 1)[0] for name in _scratch(spark) - before}
    assert "saldo-fact-inventory" in left and "saldo-warehouse-sums" in left
    assert not left & {"saldo-ods-turnover", "saldo-ods-prices"}


def test_a_released_layer_is_built_again(spark, tables):
    feeds = Feeds(spark, tables)
    n = feeds.ods_prices.count()
    feeds.release("ods-prices")
    assert feeds.ods_prices.count() == n


def test_stored_layers_leave_no_shuffles(spark, tables):
    """What was moved for a stored layer goes when it is written."""
    feeds, seen = Feeds(spark, tables), []
    names = [session.BRIEF_SHUFFLES, session.SPLIT_ALWAYS]
    before = [spark.conf.get(n, None) for n in names]
    rows = spark.range(10).groupBy("id").count()
    write = type(rows.write).parquet

    def noted(self, *args, **options):
        seen.append([spark.conf.get(n) for n in names])
        return write(self, *args, **options)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(rows.write), "parquet", noted)
        assert feeds.store("brief", rows).count() == 10
    assert seen == [["true", "true"]] and [spark.conf.get(n, None) for n in names] == before


def test_sums_need_no_shuffle_of_the_mart(spark, tables, sent_nothing, capsys):
    """Above the join with the warehouses' attributes rows lie by warehouse already."""
    feeds = Feeds(spark, tables)
    monthly, sums = _plan(feeds.monthly, capsys), _plan(marts._pre_aggregate(feeds.monthly), capsys)
    trees = [plan[: plan.index("\n\n\n")] for plan in (monthly, sums)]
    assert trees[1].count("Exchange") <= trees[0].count("Exchange")


def test_staging_keeps_only_the_numbered_rows(spark, tables):
    """The export goes once its rows are staged, those once they are numbered."""
    before = _scratch(spark)
    contract.queries()["staging_append"](spark, tables).collect()
    left = {name.rsplit("-", 1)[0] for name in _scratch(spark) - before}
    assert left == {"saldo-numbered"}


def test_numbering_does_not_move_rows(spark, sent_nothing, tmp_path):
    """Blocks of files are few and go to the rows, whatever Spark takes their size for."""
    spark.createDataFrame(
        [("f", 0, i, "x") for i in range(3)], f"file_name string, {delimited.BLOCK} long, {delimited.ROW} long, c string"
    ).write.parquet(f"{tmp_path}/staged")
    numbered = delimited.with_load_id(spark.read.parquet(f"{tmp_path}/staged"), 9)
    assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.load_id for r in numbered.collect()) == [10, 11, 12]


def test_quarantine_finds_duplicates_before_rows_move(spark, tables, capsys):
    """What was moved to find repeated keys is gone when whole rows meet them."""
    assert "Aggregate" not in _plan(contract.queries()["route_quarantine"](spark, tables), capsys)


def test_layers_are_counted_from_one_pass(spark, tables):
    """Each feed is parsed, and its duplicates are found, once for all its layers."""
    frame = contract.queries()["layer_counts"](spark, tables)
    given = {os.path.basename(f) for f in frame.inputFiles() if "saldo-" not in f}
    assert given <= {"documents.parquet"}
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_mark") == 0
