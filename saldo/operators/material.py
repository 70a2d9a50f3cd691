"""Material dimension: one row per material, the unit is overwritten (type 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Generated key. One integer always hashes to its own 64-bit value.
MATERIAL_SK = "xxhash64(material_id) AS material_sk"


def material_master(turnover: DataFrame, prices: DataFrame) -> DataFrame:
    """Every material that occurs, with the greatest unit any turnover row names."""
    # Distinct pairs first: they are found by hash, while a maximum of text sorts its rows.
    named = turnover.select("material_id", "unit").distinct()
    priced = prices.select("material_id").distinct().selectExpr(
        "material_id", "cast(NULL AS string) AS unit"
    )
    seen = named.unionByName(priced).filter("material_id IS NOT NULL")
    return seen.groupBy("material_id").agg(F.max("unit").alias("unit"))


def merge_materials(stored: DataFrame, master: DataFrame) -> DataFrame:
    """Known units replace differing ones, new materials come in, none leaves."""
    old = stored.selectExpr("material_id", "unit AS old_unit")
    new = master.selectExpr("material_id", "unit AS new_unit")
    return old.join(new, "material_id", "full_outer").selectExpr(
        MATERIAL_SK, "material_id", "coalesce(new_unit, old_unit) AS unit"
    )


def with_material_key(rows: DataFrame, materials: DataFrame) -> DataFrame:
    """Rows of known materials, with the generated key."""
    return rows.join(materials.select("material_id", "material_sk"), "material_id")
