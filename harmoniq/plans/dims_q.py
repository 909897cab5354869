"""Dimension-maintenance bindings: J16 patch, unknown patch codes, J17 replace."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.operators.dims import patch_attributes, replace_rows, unknown_patch_codes
from harmoniq.operators.harmonise import literal_table
from harmoniq.plans import register
from harmoniq.plans.common import SQL_REGION_DIM, nation_code, region_dim, table, with_ctes

# fixed value: a patch row for a code the dimension does not know
UNKNOWN_PATCH_CODE = "R9Z"


def _patch(spark, sf_dir):
    """Patch derived from suppliers: population = suppliers x 1000, area =
    suppliers x 10, centroid (0.5, 1.5); plus one unknown code."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    per = (s.join(n, s.s_nationkey == n.n_nationkey)
           .groupBy("n_regionkey", "n_nationkey").agg(F.count(F.lit(1)).alias("k")))
    p = per.select(nation_code("n_regionkey", "n_nationkey").alias("code"),
                   (F.col("k") * 1000).cast("bigint").alias("population_latest"),
                   (F.col("k") * 10.0).alias("area_km2"),
                   F.lit(0.5).alias("centroid_lat"), F.lit(1.5).alias("centroid_lon"))
    regions = table(spark, sf_dir, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"),
        F.lit(None).cast("bigint").alias("population_latest"), F.lit(None).cast("double").alias("area_km2"),
        F.lit(2.5).alias("centroid_lat"), F.lit(3.5).alias("centroid_lon"))
    unknown = literal_table(spark, [(UNKNOWN_PATCH_CODE, 0, 1.0, 9.0, 9.0)], T.StructType([
        T.StructField("code", T.StringType()), T.StructField("population_latest", T.LongType()),
        T.StructField("area_km2", T.DoubleType()), T.StructField("centroid_lat", T.DoubleType()),
        T.StructField("centroid_lon", T.DoubleType())]))
    return p.unionByName(regions).unionByName(unknown)


SQL_PATCH = f"""{SQL_REGION_DIM},
patch AS (
  SELECT 'R' || CAST(n.n_regionkey AS VARCHAR) || chr(65 + n.n_nationkey) AS code,
         CAST(COUNT(*) * 1000 AS BIGINT) AS population_latest, COUNT(*) * 10.0 AS area_km2,
         0.5 AS centroid_lat, 1.5 AS centroid_lon
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey GROUP BY n.n_regionkey, n.n_nationkey
  UNION ALL
  SELECT 'R' || CAST(r_regionkey AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), 2.5, 3.5 FROM region
  UNION ALL SELECT '{UNKNOWN_PATCH_CODE}', 0, 1.0, 9.0, 9.0
)"""


@register("dim_patch", oracle=with_ctes(SQL_PATCH, """
SELECT d.code, d.name_en, d.name_native,
       COALESCE(p.population_latest, d.population_latest) AS population_latest,
       CASE WHEN d.centroid_lat IS NULL THEN p.centroid_lat ELSE d.centroid_lat END AS centroid_lat,
       CASE WHEN d.centroid_lat IS NULL THEN p.centroid_lon ELSE d.centroid_lon END AS centroid_lon,
       COALESCE(p.area_km2, CAST(NULL AS DOUBLE)) AS area_km2
FROM rdim d LEFT JOIN patch p ON p.code = d.code"""))
def dim_patch(spark, sf_dir):
    d = region_dim(spark, sf_dir)
    out = patch_attributes(d, _patch(spark, sf_dir))
    return out.select("code", "name_en", "name_native", "population_latest", "centroid_lat",
                      "centroid_lon", "area_km2")


@register("dim_patch_unknown", oracle=with_ctes(SQL_PATCH, """
SELECT DISTINCT code FROM patch WHERE code NOT IN (SELECT code FROM rdim)"""))
def dim_patch_unknown(spark, sf_dir):
    return unknown_patch_codes(region_dim(spark, sf_dir), _patch(spark, sf_dir))


@register("dim_replace", oracle=with_ctes(SQL_REGION_DIM, """
SELECT code, name_en, population_latest FROM rdim WHERE NOT (code LIKE 'R0_' )
UNION ALL
SELECT 'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey), 'NEW ' || n_name, CAST(NULL AS BIGINT)
FROM nation WHERE n_regionkey = 0"""))
def dim_replace(spark, sf_dir):
    d = region_dim(spark, sf_dir).select("code", "name_en", "population_latest")
    n = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 0)
    rows = n.select(nation_code("n_regionkey", "n_nationkey").alias("code"),
                    F.concat(F.lit("NEW "), F.col("n_name")).alias("name_en"),
                    F.lit(None).cast("bigint").alias("population_latest"))
    return replace_rows(d, rows)
