"""What the text operators share: scratch tables, free column names, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.session import scratch_path

#: Words are runs without blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared scratch folder and read back: cuts the lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, wanted: str) -> str:
    """A column name that the frame does not use, whatever its case."""
    used = {c.lower() for c in frame.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def set_aside(
    frame: DataFrame, names: list[str], work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """work(frame) without its columns of these names, and with those that the frame itself had by them.

    For an operator whose results are needed only inside ``work``: what it adds goes, and a column of the
    frame that has such a name, whatever its case, stays.
    """
    wanted = {n.lower() for n in names}
    hidden = {}
    hiding = frame
    for column in frame.columns:
        if column.lower() in wanted:
            hidden[column] = free_name(hiding, "aside_" + column)
            hiding = hiding.withColumnRenamed(column, hidden[column])
    done = work(hiding)
    left = [c for c in done.columns if c.lower() not in wanted]
    back = {new: old for old, new in hidden.items()}
    order = {c: i for i, c in enumerate(frame.columns)}
    left.sort(key=lambda c: order.get(back.get(c, c), len(order)))
    return done.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in left])


def n_words(text) -> F.Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_columns(
    frame: DataFrame, inputs: list[str], make: Callable[..., dict[str, pa.Array]], fields: str
) -> DataFrame:
    """Add columns computed in Python batch by batch; all columns of the frame stay as they are.

    ``make`` gets one Arrow array per input column and returns the new columns. Rows are neither
    moved nor dropped. A new column takes the place of one that has its name.
    """
    added = [f.split()[0] for f in fields.split(", ")]
    kept = [c for c in frame.columns if c.lower() not in {a.lower() for a in added}]
    work, names = frame, []
    for column in inputs:  # an input may share its name with a result
        name = free_name(work, "in_" + column)
        work = work.withColumn(name, F.col(f"`{column}`"))
        names.append(name)
    work = work.select(*[F.col(f"`{c}`") for c in kept], *names)
    rest = work.drop(*names)
    target = rest.schema
    for field in _fields(fields):
        target = target.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            made = make(*[batch.column(batch.schema.get_field_index(n)) for n in names])
            arrays = [batch.column(i) for i in range(len(kept))] + [made[a] for a in added]
            yield pa.RecordBatch.from_arrays(arrays, names=kept + added)

    return work.mapInArrow(run, target)


#: What a Python worker remembers for the operator it works for.
_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]):
    """Made once per Python worker. Workers serve one operator after the other; taking up the next
    one frees what was held for the last."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


#: Bytes handed to Python code at once.
PORTION_BYTES = 4 << 20


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded size, so that what is made of one stays small."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * PORTION_BYTES / max(1, batch.nbytes)))
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def _fields(text: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(text).fields
