"""Which files to load: listing, content fingerprint, decision against the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REGISTRY_SCHEMA

NEW, SKIP, RELOAD = "NEW", "SKIP", "RELOAD"

REGISTRY_COLUMNS = [field.name for field in REGISTRY_SCHEMA]


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def plain_path(path: Column) -> Column:
    """One spelling for a path, whether it comes from a listing or from row metadata."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def list_files(
    spark: SparkSession, folder: str | list[str], pattern: str = "*.csv", recursive: bool = False
) -> DataFrame:
    """path, modificationTime, length, content of the matching files directly in the folder, or of files.

    ``content`` is only read if a query uses it. Empty files hold nothing to load and are not listed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    return files.withColumn("path", plain_path(F.col("_metadata.file_path")))


# One digest rule for files of any size. Lines end at line feeds. SHA-256 of each line, in blocks of so many
# lines; SHA-256 of a block's hex digests in their order; SHA-256 of "size|lines|digests of the blocks".
BLOCK_LINES = 65_536
# Files from this size on are read by many tasks; the digest is the same.
LARGE = 16 << 20


def content_digest(content: str, length: str, block_lines: int = BLOCK_LINES) -> str:
    """SQL for the digest of a file that is one binary value."""
    # Latin-1 stands for the bytes as they are, of whatever encoding. Like Spark's line reader, it takes a
    # byte-order mark of UTF-8 off, and no line begins after the last line feed.
    text = f"regexp_replace(decode({content}, 'ISO-8859-1'), '^\u00ef\u00bb\u00bf', '')"
    cut = f"split({text}, '\n', -1)"
    lines = f"if(endswith({text}, '\n') OR {text} = '', slice({cut}, 1, size({cut}) - 1), {cut})"
    digests = f"transform({lines}, line -> sha2(encode(line, 'ISO-8859-1'), 256))"
    numbered = f"struct({digests} AS d)"
    blocks = (
        f"transform(array({numbered}), x -> named_struct('n', size(x.d), 'b', if(size(x.d) = 0, array(''), "
        f"transform(sequence(0, (size(x.d) - 1) div {block_lines}), "
        f"i -> sha2(concat_ws('', slice(x.d, int(i * {block_lines} + 1), {block_lines})), 256)))))[0]"
    )
    return (
        f"transform(array({blocks}), f -> sha2(concat_ws('|', {length}, f.n, concat_ws('', f.b)), 256))[0]"
    )


def fingerprint(files: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Digest and byte length of files whose content is one value."""
    return files.select(
        F.col("path").alias("file_path"),
        F.expr(content_digest("content", "length", block_lines)).alias("file_hash"),
        F.col("length").cast("long").alias("file_size_bytes"),
    )


def fingerprint_large(
    files: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None, block_lines: int = BLOCK_LINES
) -> DataFrame:
    """The same, each file read by many tasks.

    Lines are numbered from counts per piece of a file. Only digests are moved, to one task per block
    of lines. ``keep`` stores them, else files are read once more for the counts. A line has to fit a row.
    """
    spark = files.sparkSession
    paths = [r.path for r in files.select("path").collect()]  # one short path per LARGE bytes
    sizes = files.select(F.col("path").alias("file_path"), F.col("length").cast("long").alias("file_size_bytes"))
    if not paths:
        return sizes.selectExpr("file_path", "cast(NULL AS string) AS file_hash", "file_size_bytes")
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_block_start").alias("piece"), F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("digest"),
    )
    lines = keep(lines) if keep else lines
    pieces = lines.groupBy("file_path", "piece").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = "sum(n) OVER (PARTITION BY file_path ORDER BY piece) - n AS before"
    numbered = lines.join(pieces.selectExpr("file_path", "piece", "first", before), ["file_path", "piece"])
    numbered = numbered.selectExpr("file_path", "digest", "before + row - first AS i")

    def in_order(number: str, digest: str) -> str:
        pairs = f"sort_array(collect_list(struct({number} AS i, digest)))"
        return f"concat_ws('', transform({pairs}, p -> {digest}))"

    # A line's digest is moved and stored as bytes, half the size of its text.
    blocks = numbered.groupBy("file_path", F.expr(f"i div {block_lines}").alias("b")).agg(
        F.expr(f"sha2({in_order('i', 'lower(hex(p.digest))')}, 256)").alias("digest"), F.count("*").alias("n")
    )
    whole = blocks.groupBy("file_path").agg(F.expr(in_order("b", "p.digest")).alias("blocks"), F.sum("n").alias("n"))
    digest = F.concat_ws("|", "file_size_bytes", F.coalesce("n", F.lit(0)), F.coalesce("blocks", F.lit("")))
    return sizes.join(whole, "file_path", "left").select(
        "file_path", F.sha2(digest, 256).alias("file_hash"), "file_size_bytes"
    )


def fingerprint_delivered(
    files: DataFrame, registry: DataFrame, large: int = LARGE,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Fingerprints and modified_at of a listing, with as little reading as it takes.

    A file that was loaded with the same size and time of change keeps its stored hash unread.
    """
    known = registry.filter("status = 'loaded'").selectExpr(
        "file_path AS path", "file_size_bytes AS length", "modified_at AS modificationTime",
        "file_hash AS known_hash",
    )
    listed = files.select("path", "modificationTime", "length")
    seen = listed.join(known, ["path", "length", "modificationTime"])
    changed = files.join(seen.select("path"), "path", "left_anti")
    prints = fingerprint(changed.filter(F.col("length") < large)).unionByName(
        fingerprint_large(changed.filter(F.col("length") >= large), keep)
    ).unionByName(seen.selectExpr("path AS file_path", "known_hash AS file_hash", "length AS file_size_bytes"))
    times = listed.selectExpr("path AS file_path", "modificationTime AS modified_at")
    return prints.join(times, "file_path")


def decide(prints: DataFrame, registry: DataFrame) -> DataFrame:
    """NEW for an unknown path, SKIP if the same content was loaded, RELOAD otherwise."""
    known = registry.select(
        "file_path", F.col("file_hash").alias("old_hash"), F.col("status").alias("old_status")
    )
    same = (F.col("old_hash") == F.col("file_hash")) & (F.col("old_status") == "loaded")
    decision = (
        F.when(F.col("old_status").isNull(), NEW).when(same, SKIP).otherwise(RELOAD)
    )
    return prints.join(known, "file_path", "left").select(*prints.columns, decision.alias("decision"))


def update_registry(registry: DataFrame, outcome: DataFrame) -> DataFrame:
    """One row per path: the outcome of this load where there is one, else the old row.

    ``outcome`` has the registry's columns and holds only files that were handled now.
    """
    path = "file_path"
    old = registry.select(path, F.struct(*REGISTRY_COLUMNS).alias("old"))
    new = outcome.select(path, F.struct(*REGISTRY_COLUMNS).alias("new"))
    merged = old.join(new, path, "full_outer").select(F.coalesce("new", "old").alias("row"))
    return merged.select("row.*")


def outcome_rows(
    decided: DataFrame, source_type: str, status: str, loaded_rows: DataFrame | None = None,
    error: str | None = None,
) -> DataFrame:
    """Registry rows for the files handled now; ``loaded_rows`` is (file_path, rows_loaded)."""
    handled = decided.filter(F.col("decision") != SKIP)
    if "modified_at" not in handled.columns:
        handled = handled.withColumn("modified_at", F.lit(None).cast("timestamp"))
    if loaded_rows is None:
        handled = handled.withColumn("rows_loaded", F.lit(None).cast("long"))
    else:
        handled = handled.join(loaded_rows, "file_path", "left").withColumn(
            "rows_loaded", F.coalesce("rows_loaded", F.lit(0)).cast("long")
        )
    loaded_at = F.when(F.lit(status == "loaded"), F.current_timestamp())
    return (
        handled.withColumn("source_type", F.lit(source_type))
        .withColumn("file_name", file_name(F.col("file_path")))
        .withColumn("status", F.lit(status))
        .withColumn("loaded_at", loaded_at)
        .withColumn("error_message", F.lit(error).cast("string"))
        .select(*REGISTRY_COLUMNS)
    )


def stem(path: Column, folder: str) -> Column:
    """Path below the folder, without extension."""
    below = F.regexp_replace(path, r"^.*?\Q" + folder.strip("/") + r"\E/", "")
    return F.regexp_replace(below, r"[.][^./]*\z", "")


def stale_outputs(sources: DataFrame, outputs: DataFrame, source_dir: str, output_dir: str):
    """Sources with no output of the same relative name, or with an older one."""
    have = outputs.select(
        stem(F.col("path"), output_dir).alias("stem"), F.col("modificationTime").alias("done_at")
    )
    want = sources.select(
        stem(F.col("path"), source_dir).alias("stem"), "path", "modificationTime"
    )
    fresh = F.col("done_at") >= F.col("modificationTime")
    return want.join(have, "stem", "left").filter(~F.coalesce(fresh, F.lit(False))).select(
        "stem", F.col("path").alias("source_path")
    )
