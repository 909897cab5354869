"""Projection/filter bindings: P3 prefix filter, P4 regex filter, P6
lenient casts (zero / drop), P7 thousands separators, P8 unpivot, and A19
grid clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmoniq.functions.text import digits_only_long, lenient_long
from harmoniq.operators.cluster import grid_clusters
from harmoniq.plans import register
from harmoniq.plans.common import table


@register("leaf_prefix_filter", oracle="""
SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2')""")
def leaf_prefix_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.filter(F.col("p_brand").startswith("Brand#1") | F.col("p_brand").startswith("Brand#2")) \
        .select("p_partkey", "p_brand")


@register("code_regex", oracle="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+$')""")
def code_regex(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderpriority").rlike(r"^[1-3]-[A-Z]+$")).select("o_orderkey", "o_orderpriority")


TEXT_K_SQL = "CASE WHEN event_type = 'error' THEN 'n/a' ELSE json_extract_string(props, '$.k') || '.7' END"


@register("lenient_cast_zero", oracle=f"""
SELECT event_id, COALESCE(CAST(trunc(TRY_CAST(trim({TEXT_K_SQL}) AS DOUBLE)) AS BIGINT), 0) AS k FROM events""")
def lenient_cast_zero(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.concat(F.get_json_object("props", "$.k"), F.lit(".7")))
    return e.select("event_id", lenient_long(text, "zero").alias("k"))


SIZE_TEXT_SQL = "CASE WHEN p_type = 'PROMO' THEN 'x' || CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END"


@register("lenient_cast_drop", oracle=f"""
SELECT p_partkey, CAST(trunc(TRY_CAST({SIZE_TEXT_SQL} AS DOUBLE)) AS BIGINT) AS size
FROM part WHERE TRY_CAST({SIZE_TEXT_SQL} AS DOUBLE) IS NOT NULL""")
def lenient_cast_drop(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    text = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("x"), F.col("p_size").cast("string"))) \
        .otherwise(F.col("p_size").cast("string"))
    return p.select("p_partkey", lenient_long(text, "null").alias("size")).filter(F.col("size").isNotNull())


@register("thousands_separators", oracle="""
SELECT event_id, event_id * 1001 AS n FROM events WHERE event_type <> 'error'""")
def thousands_separators(spark, sf_dir):
    """P7: '1.234.567' -> 1234567; placeholders '-', '.', '' are missing."""
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("-")).otherwise(
        F.regexp_replace(F.format_number(F.col("event_id") * 1001, 0), ",", "."))
    return e.select("event_id", digits_only_long(text).alias("n")).filter(F.col("n").isNotNull())


@register("unpivot_measures", oracle="""
SELECT l_orderkey, l_linenumber, measure, value FROM (
  UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE value)""")
def unpivot_measures(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return li.unpivot(["l_orderkey", "l_linenumber"],
                      ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "measure", "value")


# points in whole micro-degrees, so cell centres are exact means
LON_SQL = "(CAST(round(c_acctbal * 100) AS BIGINT) * 100 - 40000000) / 1000000.0"
LAT_SQL = "(c_nationkey * 2000000 - 20000000 + CAST(round(c_acctbal * 100) AS BIGINT)) / 1000000.0"


@register("cluster_grid", oracle=f"""
WITH p AS (SELECT {LON_SQL} AS lon, {LAT_SQL} AS lat, z.zoom FROM customer,
           (SELECT unnest(range(0, 10)) AS zoom) z),
c AS (SELECT zoom, lon, lat,
             floor(((lon + 180.0) / 360.0 * (256.0 * pow(2.0, zoom))) / 40) AS gx,
             floor(((1.0 - ln(tan(radians(lat)) + 1.0 / cos(radians(lat))) / pi()) / 2.0
                    * (256.0 * pow(2.0, zoom))) / 40) AS gy
      FROM p)
SELECT CAST(zoom AS INTEGER) AS zoom, CAST(gx AS BIGINT) AS gx, CAST(gy AS BIGINT) AS gy, COUNT(*) AS n,
       SUM(CAST(round(lon * 1000000.0) AS BIGINT)) / COUNT(*) / 1000000.0 AS lon,
       SUM(CAST(round(lat * 1000000.0) AS BIGINT)) / COUNT(*) / 1000000.0 AS lat,
       CASE WHEN COUNT(*) >= 10 THEN 2 WHEN COUNT(*) >= 5 THEN 1 ELSE 0 END AS badge
FROM c GROUP BY 1, 2, 3""")
def cluster_grid(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pts = c.select(F.expr(LON_SQL).alias("lon"), F.expr(LAT_SQL).alias("lat"))
    return grid_clusters(pts, "lon", "lat", 9, 40)
