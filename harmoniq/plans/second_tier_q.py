"""Second-tier views the reference's documents promise."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from harmoniq.operators.incidents import domain_confidence
from harmoniq.plans import register
from harmoniq.plans.common import SQL_FACTS, facts_table, table, with_ctes
from harmoniq.plans.facts_q import summary
from harmoniq.plans.incidents_q import BUCKET_SQL, DEMO_OUTLETS, HOST_SQL, page_bucket
from harmoniq.plans.views_q import _summary_cte
from harmoniq.schema import CRIME_CATEGORIES
from harmoniq.session import scratch_path


# ---- N1: year-over-year change -------------------------------------------------------------
@register("yoy_delta", oracle=with_ctes(SQL_FACTS, """
, y AS (SELECT region_code, crime_category, CAST(year(period_end) AS INTEGER) AS year, count FROM facts
        WHERE suspect_dim = 'total'),
l AS (SELECT *, lag(year) OVER (PARTITION BY region_code, crime_category ORDER BY year) AS py,
             lag(count) OVER (PARTITION BY region_code, crime_category ORDER BY year) AS pc FROM y)
SELECT region_code, crime_category, year, count,
       CASE WHEN py = year - 1 THEN pc END AS prev_count,
       CASE WHEN py = year - 1 THEN count - pc END AS delta
FROM l""".lstrip()))
def yoy_delta(spark, sf_dir):
    """Lag within (region, category) ordered by year; a gap year yields no
    delta.  Window partitions hold one series (years), not a country."""
    f = facts_table(spark, sf_dir).filter(F.col("suspect_dim") == "total").select(
        "region_code", "crime_category", F.year("period_end").cast("int").alias("year"), "count")
    w = Window.partitionBy("region_code", "crime_category").orderBy("year")
    py, pc = F.lag("year").over(w), F.lag("count").over(w)
    ok = py == F.col("year") - 1
    return f.select("region_code", "crime_category", "year", "count",
                    F.when(ok, pc).alias("prev_count"), F.when(ok, F.col("count") - pc).alias("delta"))


TOP_MOVERS = 5


@register("top_movers", oracle=with_ctes(SQL_FACTS, f"""
, y AS (SELECT region_code, crime_category, CAST(year(period_end) AS INTEGER) AS year, count FROM facts
        WHERE suspect_dim = 'total'),
l AS (SELECT *, lag(year) OVER (PARTITION BY region_code, crime_category ORDER BY year) AS py,
             lag(count) OVER (PARTITION BY region_code, crime_category ORDER BY year) AS pc FROM y),
d AS (SELECT crime_category, region_code, year, count, count - pc AS delta FROM l WHERE py = year - 1),
n AS (SELECT *, row_number() OVER (PARTITION BY crime_category, year ORDER BY abs(delta) DESC, region_code) AS place
      FROM d)
SELECT crime_category, year, CAST(place AS INTEGER) AS place, region_code, count, delta
FROM n WHERE place <= {TOP_MOVERS}""".lstrip()))
def top_movers(spark, sf_dir, n=TOP_MOVERS):
    """Per category and year the regions whose count changed most against
    the year before, by two rounds of ranks (per group and salt, then per
    group), so that no group is sorted whole in one task."""
    from harmoniq.operators.views import top_of_group
    d = yoy_delta(spark, sf_dir).filter("delta is not null")
    return top_of_group(d, ["crime_category", "year"], F.abs("delta"), "region_code", n).select(
        "crime_category", "year", "place", "region_code", "count", "delta")


# ---- N2: soft dedupe of vectors inside a block ---------------------------------------------
SOFT_COSINE, OUTLETS = 0.9, 4
# outlet k reports the same event with a summary vector of its own
REPORT_SQL = """
reports AS (
  SELECT vec_id * 4 + k AS id, label,
         list_transform(range(1, len(embedding) + 1), lambda i: CAST(embedding[i] AS DOUBLE)
           + k * CAST(0.2 AS DOUBLE) * CAST(embedding[len(embedding) + 1 - i] AS DOUBLE)) AS v
  FROM embeddings, range(4) AS t(k))"""


@register("soft_dedupe", oracle=f"""
WITH RECURSIVE {REPORT_SQL},
links AS (
  SELECT a.id AS a, b.id AS b FROM reports a JOIN reports b ON a.label = b.label AND a.id <> b.id
  WHERE list_cosine_similarity(a.v, b.v) >= {SOFT_COSINE}),
reach AS (SELECT id, id AS other FROM reports UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.id, min(r.other) AS class_id, (SELECT count(*) FROM links l WHERE l.a = r.id) AS n_links
FROM reach r GROUP BY r.id""")
def soft_dedupe(spark, sf_dir):
    """Reports of one country (here: the label) whose summary vectors have
    a cosine of at least 0.9 are one event; each report gets its class and the
    number of reports it matches.  The reports are the table's vectors as four
    outlets would give them."""
    from harmoniq.operators.soft_dedupe import soft_classes
    e = table(spark, sf_dir, "embeddings")
    own = F.transform("embedding", lambda c: c.cast("double"))
    reports = e.select("label", F.col("vec_id"), own.alias("own"), F.reverse(own).alias("other"),
                       F.explode(F.sequence(F.lit(0), F.lit(OUTLETS - 1))).alias("k")).select(
        (F.col("vec_id") * OUTLETS + F.col("k")).alias("id"), "label",
        F.zip_with("own", "other", lambda a, b: a + F.col("k") * F.lit(0.2) * b).alias("vector"))
    return soft_classes(reports, "id", "vector", ["label"], SOFT_COSINE, 64)


# ---- N3: visibility gate ---------------------------------------------------------------------
@register("visibility", oracle=f"""
WITH d AS (SELECT DISTINCT {BUCKET_SQL} AS bucket, regexp_replace({HOST_SQL}, '^www\\.', '') AS domain
           FROM pages),
o(outlet) AS (VALUES {", ".join(f"('{o}')" for o in DEMO_OUTLETS)}),
g AS (
  SELECT bucket, COUNT(*) FILTER (WHERE domain <> '') AS n_domains,
         max(CASE WHEN domain <> '' AND EXISTS (SELECT 1 FROM o WHERE d.domain = o.outlet
                                                 OR ends_with(d.domain, '.' || o.outlet)) THEN 1 ELSE 0 END) AS listed
  FROM d GROUP BY bucket
),
c AS (SELECT bucket, CASE WHEN listed = 1 THEN 'HIGH' WHEN n_domains >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence
      FROM g)
SELECT bucket, confidence FROM c WHERE confidence IN ('HIGH', 'MEDIUM')""")
def visibility(spark, sf_dir, levels=("HIGH", "MEDIUM")):
    p = table(spark, sf_dir, "pages").select(page_bucket().alias("bucket"), "url")
    c = domain_confidence(p, "bucket", "url", DEMO_OUTLETS)
    return c.filter(F.col("confidence").isin(*levels)).select("bucket", "confidence")


# ---- N4: stale sources --------------------------------------------------------------------------
STALE_AS_OF = "2002-04-15"


@register("stale_flag", oracle=f"""
WITH l AS (SELECT c.c_nationkey, CAST(max(o.o_orderdate) AS DATE) AS latest
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1)
SELECT c_nationkey, latest, CAST(latest + INTERVAL 9 MONTH AS DATE) < DATE '{STALE_AS_OF}' AS stale FROM l""")
def stale_flag(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    latest = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey")
              .agg(F.to_date(F.max("o_orderdate")).alias("latest")))
    return latest.withColumn("stale", F.add_months("latest", 9) < F.to_date(F.lit(STALE_AS_OF)))


# ---- N5: weapon mix per country ---------------------------------------------------------------
WEAPON_SQL = "CASE WHEN value < 100 THEN 'knife' WHEN value < 300 THEN 'firearm' ELSE 'other' END"


@register("weapon_mix", oracle=f"""
WITH g AS (SELECT upper(substr(event_type, 1, 2)) AS country, {WEAPON_SQL} AS weapon, COUNT(*) AS n
           FROM events GROUP BY 1, 2)
SELECT country, weapon, n, round(100.0 * n / sum(n) OVER (PARTITION BY country), 1) AS share_pct FROM g""")
def weapon_mix(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    g = e.groupBy(F.upper(F.substring("event_type", 1, 2)).alias("country"),
                  F.expr(WEAPON_SQL).alias("weapon")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("country")      # after aggregation: a few rows per country
    return g.withColumn("share_pct", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(w), 1))


# ---- N7: 'not published' tags ---------------------------------------------------------------------
@register("not_published", oracle=with_ctes(SQL_FACTS, f"""
, c AS (SELECT DISTINCT source_country FROM facts),
k(crime_category) AS (VALUES {", ".join(f"('{x}')" for x in CRIME_CATEGORIES)}),
have AS (SELECT source_country, crime_category, COUNT(*) AS n FROM facts GROUP BY 1, 2)
SELECT c.source_country, k.crime_category,
       CASE WHEN h.n IS NULL THEN 'not published' ELSE 'published' END AS status
FROM c CROSS JOIN k LEFT JOIN have h ON h.source_country = c.source_country AND h.crime_category = k.crime_category
""".lstrip()))
def not_published(spark, sf_dir):
    f = facts_table(spark, sf_dir)
    grid = f.select("source_country").distinct().select(
        "source_country", F.explode(F.array(*[F.lit(x) for x in CRIME_CATEGORIES])).alias("crime_category"))
    have = f.groupBy("source_country", "crime_category").agg(F.count(F.lit(1)).alias("n"))
    j = grid.join(have, ["source_country", "crime_category"], "left")
    return j.select("source_country", "crime_category",
                    F.when(F.col("n").isNull(), "not published").otherwise("published").alias("status"))


# ---- N8: pre-aggregated overview, written partitioned by country --------------------------------
@register("overview", oracle=with_ctes(_summary_cte(), """
SELECT region_code, region_level, homicide_count, homicide_rate, population, source_country FROM summary"""))
def overview(spark, sf_dir):
    s = summary(spark, sf_dir).select("region_code", "region_level", "homicide_count", "homicide_rate",
                                      "population", "source_country")
    path = scratch_path(spark, "overview")
    s.write.partitionBy("source_country").parquet(path)
    return spark.read.parquet(path)


# ---- N6: point-in-polygon over the nation squares written as GeoJSON --------------------------
PIP_LON_SQL = ("CAST(n_nationkey * 2.0 + CASE WHEN c_mktsegment = 'MACHINERY' THEN 1.5 "
               "ELSE ((c_custkey % 97) + 1) / 100.0 END AS DOUBLE)")
PIP_LAT_SQL = "CAST(n_regionkey * 3.0 + ((c_custkey % 89) + 1) / 100.0 AS DOUBLE)"


@register("point_in_polygon", oracle=f"""
SELECT c_custkey, {PIP_LON_SQL} AS lon, {PIP_LAT_SQL} AS lat,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
            ELSE 'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) END AS region_code
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def point_in_polygon(spark, sf_dir):
    """Customers placed inside their nation's square (or, for one segment,
    in the gap between squares) are assigned back to a region by
    geometry alone."""
    from harmoniq.operators.spatial import assign_regions
    return assign_regions(*_points_and_regions(spark, sf_dir), "c_custkey", "lon", "lat")


@register("point_candidates", oracle=f"""
SELECT c_custkey, c_mktsegment <> 'MACHINERY' AS found, true AS few_candidates,
       true AS tested_in_border_cells_only
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def point_candidates(spark, sf_dir):
    """What the covering costs a point: it meets at most one cell per size
    and polygon (the squares do not overlap), and a point that a whole cell
    decides takes no exact test."""
    from harmoniq.operators.spatial import LEVELS, assign_regions
    got = assign_regions(*_points_and_regions(spark, sf_dir), "c_custkey", "lon", "lat", report=True)
    return got.select("c_custkey", F.col("region_code").isNotNull().alias("found"),
                      (F.col("candidates") <= LEVELS).alias("few_candidates"),
                      (F.col("tests") <= F.col("candidates")).alias("tested_in_border_cells_only"))


def _points_and_regions(spark, sf_dir):
    from harmoniq.plans.readers_q import write_region_geojson
    from harmoniq.sources.files import read_geojson
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    pts = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.expr(PIP_LON_SQL).alias("lon"), F.expr(PIP_LAT_SQL).alias("lat"))
    g = read_geojson(spark, f"{write_region_geojson(spark, sf_dir)}/*")
    return pts, g.select(F.col("properties")["NUTS_ID"].alias("code"), "geometry")
