"""Delimited UTF-16LE files with line breaks inside quotes, each read by many tasks.

A file is cut at bytes that look like a line feed. A cut is the end of a record only if it lies on a whole
character and outside of quotes, and both depend on everything before it: on the number of bytes and of quotes,
even or odd. A task finds both for its piece under either assumption about how the piece begins.
A prefix sum over the pieces, one row each, then says how each begins. Most lines turn out to be whole
records and stay where they are; only parts of records with line breaks are put together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import plain_path

PIECE, ROW = "_piece", "_row"
LINE_SCHEMA = (
    f"file_name string, {PIECE} long, {ROW} long, line binary, odd int, odd_before int, quotes array<int>, "
    "quotes_before array<int>"
)


def _odd_quotes(lines: pa.Array) -> np.ndarray:
    """Per line whether its quotes are odd in number: if it begins on a character, and if one byte later."""
    found = np.zeros((len(lines), 2), np.int64)
    if not len(lines):
        return found
    offsets = np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4).astype(np.int64)
    bytes_ = np.frombuffer(lines.buffers()[2] or b"", np.uint8)
    low, high = offsets[0], offsets[-1]
    here = bytes_[low:high]
    places = np.flatnonzero((here[:-1] == 0x22) & (here[1:] == 0)) + low
    line = np.searchsorted(offsets, places, side="right") - 1
    inside = places + 1 < offsets[line + 1]
    places, line = places[inside], line[inside]
    np.add.at(found, (line, (places - offsets[line]) % 2), 1)
    return found % 2


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to each line what its bytes and quotes change, and what those before it in its piece changed.

    ``quotes`` has one entry for each way the piece may begin: on a character, or in the middle of one.
    """
    piece, odd_sum, quote_sum = None, 0, np.zeros(2, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        names, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lines = batch.column(3).cast(pa.binary())
        odd = np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4).astype(np.int64)
        odd = np.diff(odd) % 2
        by_begin = _odd_quotes(lines)
        odd_before, quotes, quotes_before = [], [], []
        for i in range(len(lines)):
            if (names[i], starts[i]) != piece:
                piece, odd_sum, quote_sum = (names[i], starts[i]), 0, np.zeros(2, np.int64)
            # A line that begins in the middle of a character has its characters one byte later.
            own = by_begin[i][::-1] if odd_sum else by_begin[i]
            odd_before.append(odd_sum)
            quotes.append(own.tolist())
            quotes_before.append(quote_sum.tolist())
            odd_sum, quote_sum = odd_sum ^ int(odd[i]), quote_sum ^ own
        pairs = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], lines, pa.array(odd, pa.int32()), pa.array(odd_before, pa.int32()),
             pa.array(quotes, pairs), pa.array(quotes_before, pairs)],
            names=[f.split()[0] for f in LINE_SCHEMA.split(", ")],
        )


def counted_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of the files as bytes, each with its place and parities."""
    lines = spark.read.options(encoding="UTF-16LE", lineSep="\n").text(paths)
    placed = lines.select(
        plain_path(F.col("_metadata.file_path")).alias("file_name"),
        F.col("_metadata.file_block_start").alias(PIECE), F.monotonically_increasing_id().alias(ROW),
        F.col("value").cast("binary").alias("line"),
    )
    return placed.mapInArrow(_counted, LINE_SCHEMA)


def records(
    spark: SparkSession, paths: str | list[str], keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The files' records as text, with file_name, the piece they begin in and their number in it.

    ``keep`` stores the lines, else files are read again for the pieces. A record has to fit a row. Quotes
    that are never closed make everything after them one record, as in any reader.
    """
    lines = counted_lines(spark, paths)
    lines = keep(lines) if keep else lines
    # One row per piece of a file.
    ends = lines.groupBy("file_name", PIECE).agg(
        F.max_by(F.expr("odd_before ^ odd"), ROW).alias("odd_end"),
        F.max_by(F.expr("zip_with(quotes_before, quotes, (a, b) -> a ^ b)"), ROW).alias("quotes_end"),
    )
    earlier = f"OVER (PARTITION BY file_name ORDER BY {PIECE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    pieces = ends.selectExpr(
        "file_name", PIECE, "quotes_end", f"coalesce(sum(odd_end) {earlier}, 0) % 2 AS begin_odd"
    ).selectExpr(
        "file_name", PIECE, "begin_odd",
        f"coalesce(sum(quotes_end[int(begin_odd)]) {earlier}, 0) % 2 AS begin_quoted",
    )
    at = "int(begin_odd)"
    states = lines.join(pieces, ["file_name", PIECE]).selectExpr(
        "file_name", PIECE, ROW, "line", f"(odd_before ^ {at}) = 0 AND (quotes_before[{at}] ^ int(begin_quoted)) = 0 AS begins",
        f"(odd_before ^ odd ^ {at}) = 0 AND (quotes_before[{at}] ^ quotes[{at}] ^ int(begin_quoted)) = 0 AS ends",
    )
    # A filter on the text may be moved below this one, so parts of characters are kept from decoding.
    whole = states.filter("begins AND ends").selectExpr(
        "file_name", PIECE, ROW, "if(begins AND ends, decode(line, 'UTF-16LE'), NULL) AS record"
    )
    joined = _joined(states.filter("NOT (begins AND ends)"))
    return whole.unionByName(joined.selectExpr("file_name", PIECE, ROW, "decode(line, 'UTF-16LE') AS record"))


def _joined(parts: DataFrame) -> DataFrame:
    """Records of several lines. A part belongs to the last line before it that begins a record, in
    its own piece or, of lines before the first such line, in the last earlier piece that has one."""
    in_piece = f"OVER (PARTITION BY file_name, {PIECE} ORDER BY {ROW})"
    own = parts.selectExpr("*", f"last(if(begins, {ROW}, NULL), true) {in_piece} AS start_row")
    last = parts.groupBy("file_name", PIECE).agg(F.expr(f"max(if(begins, {ROW}, NULL)) AS last_row"))
    earlier = f"OVER (PARTITION BY file_name ORDER BY {PIECE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    open_ = f"last(if(last_row IS NULL, NULL, struct({PIECE} AS piece, last_row AS row)), true) {earlier} AS open"
    before = last.selectExpr("file_name", PIECE, open_)  # one row per piece
    named = own.join(before, ["file_name", PIECE]).selectExpr(
        "file_name", f"if(start_row IS NULL, open.piece, {PIECE}) AS start_piece",
        "coalesce(start_row, open.row) AS start_row", f"struct({PIECE} AS piece, {ROW} AS row, line) AS part",
    )
    grouped = named.groupBy("file_name", "start_piece", "start_row").agg(
        F.sort_array(F.collect_list("part")).alias("parts")
    )
    cut = "unhex('0A00')"
    text = (
        f"aggregate(slice(parts, 2, size(parts)), parts[0].line, (text, p) -> concat(text, {cut}, p.line)) AS line"
    )
    return grouped.selectExpr("file_name", f"start_piece AS {PIECE}", f"start_row AS {ROW}", text)


def scan_quoted(
    spark: SparkSession, paths: str | list[str], schema: str, options: dict[str, str],
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The records' fields, without the first record of each file; the places of records are kept.

    Blank lines between records are no records. ``options`` are those of a delimited file.
    """
    found = records(spark, paths, keep)
    # The first record of a file is the one with the first row of the piece at its beginning.
    firsts = found.filter(f"{PIECE} = 0").groupBy("file_name").agg(F.min(ROW).alias("_first"))
    rows = found.join(F.broadcast(firsts), "file_name", "left")  # one row per file
    rows = rows.filter(f"NOT ({PIECE} = 0 AND {ROW} = _first) AND trim(record) <> ''")
    parsed = F.from_csv("record", schema, {**options, "header": "false", "multiLine": "true", "mode": "PERMISSIVE"})
    in_piece = f"row_number() OVER (PARTITION BY file_name, {PIECE} ORDER BY {ROW}) AS {ROW}"
    return rows.select("file_name", PIECE, ROW, parsed.alias("_f")).selectExpr("file_name", PIECE, in_piece, "_f.*")
