"""Region-dimension maintenance: attribute patches, row replacement and
code-hierarchy helpers.  Dimensions are small and keyed by code; patches
join on the key (AQE broadcasts them when measured small)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmoniq.functions.codes import country_of, level_of, parent_of


def patch_attributes(dim: DataFrame, patch: DataFrame, code: str = "code") -> DataFrame:
    """Overwrite population and area from the patch where given; fill
    the centroid only where the dimension has none (the pair is guarded by
    the latitude alone).  Codes unknown to the dimension are ignored here
    and reported by :func:`unknown_patch_codes`."""
    p = patch.select(F.col(code).alias("__pc"),
                     F.col("population_latest").cast("bigint").alias("__pop"),
                     F.col("area_km2").cast("double").alias("__area"),
                     F.col("centroid_lat").cast("double").alias("__lat"),
                     F.col("centroid_lon").cast("double").alias("__lon"))
    j = dim.join(p, dim[code] == p.__pc, "left")
    no_centroid = F.col("centroid_lat").isNull()
    out = (j.withColumn("population_latest", F.coalesce("__pop", "population_latest"))
           .withColumn("area_km2", F.coalesce("__area", "area_km2"))
           .withColumn("centroid_lon", F.when(no_centroid, F.col("__lon")).otherwise(F.col("centroid_lon")))
           .withColumn("centroid_lat", F.when(no_centroid, F.col("__lat")).otherwise(F.col("centroid_lat"))))
    return out.select(*dim.columns)


def unknown_patch_codes(dim: DataFrame, patch: DataFrame, code: str = "code") -> DataFrame:
    return patch.select(code).distinct().join(dim.select(code), code, "left_anti")


def replace_rows(dim: DataFrame, rows: DataFrame, code: str = "code",
                 drop_codes: DataFrame | None = None) -> DataFrame:
    """Delete the given codes (default: the codes of ``rows``) and
    append ``rows``."""
    gone = (drop_codes if drop_codes is not None else rows).select(code).distinct()
    return dim.join(gone, code, "left_anti").unionByName(rows.select(*dim.columns))


def with_hierarchy(df: DataFrame, code: str = "code") -> DataFrame:
    """level, parent and country columns derived from a code."""
    return (df.withColumn("level", level_of(code).cast("int"))
            .withColumn("parent_code", parent_of(code))
            .withColumn("country", country_of(code)))
