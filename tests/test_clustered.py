"""A slice of a clustered table reads the files of its values only."""

from saldo.sources.clustered import Clustered, files_of, read_slice, write_clustered


def test_slices_read_their_own_files(spark, tmp_path):
    """A value with a third of all rows is split, null is a value, unknown ones have no file."""
    rows = spark.range(30_000).selectExpr(
        "if(id % 2 = 0, 'warehouse', 'shop') AS level",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 101 = 0 THEN NULL ELSE concat('z', id % 500) END AS zone", "id",
    )
    rows.write.parquet(f"file://{tmp_path}/stored")
    stored = spark.read.parquet(f"file://{tmp_path}/stored")
    table = Clustered(f"file://{tmp_path}/rows", f"file://{tmp_path}/ranges", ("level", "zone"))
    write_clustered(stored, table, ["id"], rows_per_file=500)
    n_files = spark.read.parquet(table.ranges).count()
    assert 50 <= n_files <= 60
    for wanted, most in (([("shop", "z7")], 2), ([("warehouse", "hot")], 13), ([("shop", None)], 2),
                         ([("shop", "z7"), ("warehouse", "z8")], 4), ([("zzz", "a")], 1), ([], 0)):
        assert len(files_of(spark, table, wanted)) <= most, wanted
        found = sorted(r.id for r in read_slice(spark, table, wanted).collect())
        assert found == sorted(r.id for r in stored.collect() if (r.level, r.zone) in wanted), wanted
    thousand = [("shop", f"z{i}") for i in range(250)] + [("warehouse", f"z{i}") for i in range(250)]
    assert read_slice(spark, table, thousand).count() == stored.filter(
        "zone LIKE 'z%' AND int(substr(zone, 2)) < 250").count()
    write_clustered(stored.limit(0), Clustered(f"file://{tmp_path}/e", f"file://{tmp_path}/er", ("level", "zone")))
    assert read_slice(spark, Clustered(f"file://{tmp_path}/e", f"file://{tmp_path}/er", ("level", "zone")),
                      [("shop", "z7")]).count() == 0
