"""Files with line breaks inside quotes, cut into many pieces, against a reading by one task."""

import csv
import io
import random

import pytest

from saldo.sources import delimited

# Cells that tell: breaks, quotes, separators, and characters whose bytes look like a line feed.
CELLS = ["", "a", "two\nlines", "\n", "\n\n", 'say "x"', '"', ";", "x;\ny", "Њ", "ਅĀ", "ਅ\nĀ", "Ċ\n\"Ċ\"", "б" * 40, "ਅĀ" * 5 + "\n"]


def delivered(path, seed, n):
    """A file of price rows; returns its rows."""
    pick = random.Random(seed)
    rows = [[pick.choice(CELLS) for _ in range(3)] + [str(i), "7"] for i in range(n)]
    text = io.StringIO()
    writer = csv.writer(text, delimiter=";", lineterminator="\n")
    writer.writerow(["the\nfirst", "row", "is", 'no "data"', "row"])
    for row in rows:
        writer.writerow(row)
        if pick.random() < 0.1:
            text.write("\n")  # a blank line between rows
    path.write_bytes(text.getvalue().encode("utf-16"))
    return [tuple(cell or None for cell in row) for row in rows]


@pytest.mark.parametrize("piece", ["300", "1001", "100000"])
def test_equal_to_what_was_written(spark, tmp_path, piece):
    folder = tmp_path / "in"
    folder.mkdir()
    wanted = delivered(folder / "a.csv", piece, 300) + delivered(folder / "b.csv", "b", 9)
    (folder / "c.csv").write_bytes("h;h\n".encode("utf-16"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    try:
        rows = delimited.scan(spark, "prices", f"file://{folder}", positions=True, quoted_breaks=True)
        rows.write.parquet(f"file://{tmp_path}/rows")
        if piece == "300":
            assert spark.read.text(f"file://{folder}").rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    numbered = delimited.with_load_id(spark.read.parquet(f"file://{tmp_path}/rows")).orderBy("load_id").collect()
    assert [tuple(r)[2:] for r in numbered] == wanted
    assert [r.load_id for r in numbered] == list(range(len(wanted)))
    assert {r.file_name.rsplit("/", 1)[-1] for r in numbered} == {"a.csv", "b.csv"}
