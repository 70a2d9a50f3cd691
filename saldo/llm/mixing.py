"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within its source documents are put in order of that key,
a distributed prefix sum of the sizes tells where each begins, and the source's budget cuts the
order at its exact word. A source whose budget exceeds its size is read again from the start.

The prefix sum is made in two steps, so that a source with a third of all rows is not one task: the
range of keys of a source is cut into equal parts of some PART_ROWS rows (keys are uniform), parts
are summed, and only the sums are added up along the source; then each part is added up by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import WORD, free_name, n_words, stored

PART_ROWS = 1_000
WEIGHTS = (5, 2, 1)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: int = 2) -> DataFrame:
    """sizes (source, source_size, source_rows) with target and the source's place.

    Weights are dealt in turn to the sources by code point, null last. All targets together are
    share times all sizes. No target exceeds limit times its source: what is above goes to the
    others by weight, until none is above. That is the level lambda at which min(cap, lambda *
    weight) adds up: with sources by cap per weight, the largest level any prefix of full sources
    leaves for the rest. One row per source, so the ordering over all of them is small.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)

    def earlier(column: str):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    def total(column: str):
        return F.sum(column).over(everything)

    left = F.lit(float(share)) * total("source_size") - earlier("cap")
    return (
        sizes.withColumn("place", F.row_number().over(in_order)).withColumn("weight", weight)
        .withColumn("cap", F.lit(limit) * F.col("source_size"))
        .withColumn("level", left / (total("weight") - earlier("weight")))
        .withColumn("top", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("top") * F.col("weight")))
        .select("source", "source_size", "source_rows", "place", "target")
    )


def mix(
    docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share: float = 1.5, limit: int = 2,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """docs with size, source_size, target, and parts: the words taken of the document in each epoch.

    size counts words; the text of null has none. The null source is one source. Sums of parts over
    a source equal its target rounded to whole words; in an epoch that is cut short all documents
    before the cut are whole, the one at the cut has the words up to it, those behind it have 0.
    The order depends on seed and id only, so reruns agree; rows with equal ids are ordered by size
    and text, and equal rows are interchangeable. Empty tables give empty results. Columns of docs
    named like a result are replaced by it.
    """
    results = ["size", "source_size", "target", "parts"]
    rows = docs.drop(*[c for c in docs.columns if c.lower() in results])
    names = {}
    for helper in ["key", "src", "place", "source_rows", "part", "before", "start", "digest"]:
        names[helper] = free_name(rows, "mix_" + helper)
    key, src, part = names["key"], names["src"], names["part"]
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))))
    rows = stored(
        rows.withColumn("size", n_words(F.col(f"`{text}`")))
        .withColumn(key, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
        .withColumn(names["digest"], F.xxhash64(F.col(f"`{text}`"))),
        "mix-rows",
    )
    sizes = rows.groupBy(F.col(f"`{source}`").alias("source")).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    plan = stored(targets(sizes, weights, share, limit), "mix-targets").select(
        F.col("source").alias(src), "source_size", F.col("source_rows").alias(names["source_rows"]),
        F.col("place").alias(names["place"]), "target",
    )
    rows = rows.join(plan, F.col(f"`{source}`").eqNullSafe(F.col(src))).drop(src)
    # 60 bits of key: its upper 32 times the number of parts, divided by 2^32, is the part.
    n_parts = F.ceil(F.col(names["source_rows"]) / PART_ROWS)
    rows = rows.withColumn(part, F.shiftright(F.shiftright(F.col(key), 28) * n_parts, 32))
    in_part = [names["place"], part]
    sums = rows.groupBy(*in_part).agg(F.sum("size").alias(names["before"]))
    along = Window.partitionBy(names["place"]).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(names["before"], F.coalesce(F.sum(names["before"]).over(along), F.lit(0)))
    within = (
        Window.partitionBy(*in_part).orderBy(key, f"`{doc_id}`", "size", names["digest"])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start = F.col(names["before"]) + F.sum("size").over(within) - F.col("size")
    budget = F.round("target").cast("long")

    def taken(epoch: int):
        open_words = budget - epoch * F.col("source_size") - F.col(names["start"])
        return F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), open_words))

    return (
        rows.join(sums, in_part).withColumn(names["start"], start)
        .withColumn("parts", F.array(*[taken(e) for e in range(math.ceil(limit))]))
        .drop(*names.values())
    )


def mixed(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """The mix itself: docs as often as taken, the one at a cut with its first words only.

    Documents without a word are in no mix. n_chars, if there, is set anew where a text was cut.
    """
    plan = mix(docs, text=text, **options)
    words = free_name(plan, "mix_words")
    taken = plan.withColumn(words, F.explode(F.filter("parts", lambda p: p > 0)))
    cut = F.col(words) < F.col("size")
    heads = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(heads, F.lit(1), F.col(words).cast("int")), "")
    taken = taken.withColumn(text, F.when(cut, head).otherwise(F.col(f"`{text}`")))
    if n_chars in docs.columns:
        length = F.length(F.col(f"`{text}`")).cast(docs.schema[n_chars].dataType)
        taken = taken.withColumn(n_chars, F.when(cut, length).otherwise(F.col(f"`{n_chars}`")))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
