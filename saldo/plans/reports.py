"""Reports on a run: counts per layer, quarantine composition, unknown share, losses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import safe_ratio
from ..operators.calendar import outside_calendar
from ..operators.rules import SEPARATOR
from ..operators.warehouse import UNKNOWN_TYPE


def layer_counts(layers: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (layer, feed), empty ones too; summed per task before the shuffle."""
    spark = next(iter(layers.values())).sparkSession
    marks = spark.createDataFrame([(*name, 0) for name in layers], "layer string, feed string, n long")
    for (layer, feed), rows in layers.items():
        marks = marks.union(rows.select(F.lit(layer), F.lit(feed), F.lit(1).cast("long")))
    return marks.groupBy("layer", "feed").agg(F.sum("n").alias("n_rows"))


def counted_layers(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The same from counts that the writers of a load kept, by "layer/feed"; no layer is read."""
    rows = [(*table.split("/", 1), n) for table, n in sorted(counts.items())]
    return spark.createDataFrame(rows, "layer string, feed string, n_rows long")


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    """Single reasons of all quarantined rows, with their row counts."""
    whole = quarantine.groupBy("error_reason").agg(F.count("*").alias("n"))
    single = F.explode(F.split("error_reason", SEPARATOR)).alias("reason")
    return whole.select(single, "n").groupBy("reason").agg(F.sum("n").alias("n_rows"))


def unknown_share(turnover: DataFrame, versions: DataFrame) -> DataFrame:
    """Codes that have only a placeholder, their rows, and their share of all rows in percent."""
    by_code = turnover.groupBy("warehouse_code").agg(F.count("*").alias("n"))
    current = versions.filter("is_current").selectExpr(
        "warehouse_code", f"warehouse_type = '{UNKNOWN_TYPE}' AS is_unknown"
    )
    totals = by_code.join(current, "warehouse_code", "left").selectExpr(
        "count_if(is_unknown) AS unknown_codes",
        "coalesce(sum(CASE WHEN is_unknown THEN n END), 0) AS unknown_rows",
        "sum(n) AS all_rows",
    )
    return totals.selectExpr(
        "*", f"{safe_ratio('unknown_rows * 100', 'all_rows', 2)} AS unknown_percent"
    )


def lost_rows(turnover: DataFrame, calendar: DataFrame, materials: DataFrame) -> DataFrame:
    """Clean rows that cannot become facts, by the lookup that loses them."""
    outside = outside_calendar(turnover, calendar).agg(F.count("*").alias("n_rows"))
    by_material = turnover.groupBy("material_id").agg(F.count("*").alias("n"))
    homeless = by_material.join(materials.select("material_id"), "material_id", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")
    )
    return outside.select(F.lit("calendar").alias("lookup"), "n_rows").unionByName(
        homeless.select(F.lit("material").alias("lookup"), "n_rows")
    )


def version_overlap(facts: DataFrame, versions: DataFrame) -> DataFrame:
    """Periods and materials whose facts lie under several versions of one warehouse.

    Facts are unique per version, so a plain count per code is the count of distinct versions.
    """
    codes = versions.select("warehouse_sk", "warehouse_code")
    return (
        facts.join(codes, "warehouse_sk")
        .groupBy("date_key_start", "date_key_end", "warehouse_code", "material_sk")
        .agg(F.count("*").alias("n_versions"))
        .filter("n_versions > 1")
    )


def file_status(registry: DataFrame) -> DataFrame:
    """Latest status per file, failed ones first."""
    return registry.select(
        "source_type", "file_path", "status", "rows_loaded", "error_message"
    ).orderBy(F.col("status") != "failed", "source_type", "file_path")
