"""Serving and bookkeeping bindings: A15/A18 run and parse statistics,
J14/J18/P25/O5 status list and detail lookups, O2/O4 SQL surface, F11/T3
run-month windows, X1-X5 declarative source family."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.codes import month_window
from harmoniq.operators import views as V
from harmoniq.operators.harmonise import SourceSpec, harmonise, literal_table, run_sources
from harmoniq.plans import register
from harmoniq.plans.common import (AS_OF, CATEGORY_PAIRS, SQL_FACTS, SQL_REGION_DIM, facts_table, region_dim,
                                   region_map, table, with_ctes)
from harmoniq.plans.facts_q import summary
from harmoniq.plans.views_q import _summary_cte
from harmoniq.schema import CRIME_AGGREGATES
from harmoniq.session import scratch_path
from harmoniq.sql import register_views, run_sql


# ---- A15 / A18 / F22 / F24 ------------------------------------------------------------------
@register("run_stats", oracle=with_ctes(SQL_FACTS, f"""
SELECT min(period_start) AS min_period, max(period_end) AS max_period, COUNT(*) AS n_rows,
       COUNT(DISTINCT region_code) AS n_regions, TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}' AS finished_at
FROM facts"""))
def run_stats(spark, sf_dir):
    f = facts_table(spark, sf_dir)
    return f.agg(F.min("period_start").alias("min_period"), F.max("period_end").alias("max_period"),
                 F.count(F.lit(1)).alias("n_rows"), F.count_distinct("region_code").alias("n_regions"),
                 F.lit(str(AS_OF)).cast("timestamp_ntz").alias("finished_at"))


@register("parse_stats", oracle="""
SELECT COUNT(DISTINCT o_custkey) AS n_areas, COUNT(DISTINCT o_orderpriority) AS n_categories,
       min(year(o_orderdate)) AS min_year, max(year(o_orderdate)) AS max_year FROM orders""")
def parse_stats(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    y = F.year("o_orderdate").cast("bigint")
    return o.agg(F.count_distinct("o_custkey").alias("n_areas"),
                 F.count_distinct("o_orderpriority").alias("n_categories"),
                 F.min(y).alias("min_year"), F.max(y).alias("max_year"))


# ---- J14 / O5: static country list left-joined to freshness metadata -----------------------------
# fixed values: the list of countries the site shows (one has no data)
STATUS_LIST = ["R0", "R1", "R2", "R3", "R4", "R9"]


@register("status_list", oracle=with_ctes(SQL_FACTS, f"""
, meta AS (SELECT source_country AS country, max(period_end) AS latest_period_end, COUNT(*) AS n_rows
           FROM facts GROUP BY 1),
lst(iso) AS (VALUES {", ".join(f"('{c}')" for c in STATUS_LIST)})
SELECT l.iso, m.latest_period_end, m.n_rows FROM lst l LEFT JOIN meta m ON m.country = l.iso
ORDER BY l.iso""".lstrip()))
def status_list(spark, sf_dir):
    meta = V.freshness(facts_table(spark, sf_dir)).select("country", "latest_period_end", "n_rows")
    lst = literal_table(spark, [(c,) for c in STATUS_LIST], T.StructType([T.StructField("iso", T.StringType())]))
    return (lst.join(meta, lst.iso == meta.country, "left")
            .select("iso", "latest_period_end", "n_rows").orderBy("iso"))


@register("detail_lookup", oracle=with_ctes(_summary_cte(), """
, meta AS (SELECT source_country AS country, max(period_end) AS latest_period_end, COUNT(*) AS n_rows
           FROM facts GROUP BY 1)
SELECT s.region_code, s.region_level, s.homicide_rate, m.latest_period_end, m.n_rows
FROM summary s LEFT JOIN meta m ON m.country = left(s.region_code, 2)
WHERE s.region_level > 0 OR s.source_country IN ('R0')""".lstrip()))
def detail_lookup(spark, sf_dir):
    s = summary(spark, sf_dir).filter((F.col("region_level") > 0) | F.col("source_country").isin("R0"))  # P25
    meta = V.freshness(facts_table(spark, sf_dir)).select("country", "latest_period_end", "n_rows")
    j = s.join(meta, F.left(s.region_code, F.lit(2)) == meta.country, "left")
    return j.select("region_code", "region_level", "homicide_rate", "latest_period_end", "n_rows")


# ---- O4 / O2: SQL surface ---------------------------------------------------------------------
SQL_CAP_TEXT = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10;"


@register("sql_cap", oracle=SQL_CAP_TEXT.rstrip(";"))
def sql_cap(spark, sf_dir):
    register_views({"orders": table(spark, sf_dir, "orders")})
    return run_sql(spark, SQL_CAP_TEXT, cap=1000)


SQL_TOP10 = """SELECT region_code, CAST(year(period_end) AS INT) AS year, ROUND(rate_per_100k, 2) AS rate
FROM crime_aggregates WHERE suspect_dim = 'total' AND crime_category = 'homicide'
ORDER BY rate_per_100k DESC, region_code, year LIMIT 10"""


@register("sql_top10", oracle=with_ctes(SQL_FACTS, SQL_TOP10.replace("crime_aggregates", "facts")
                                        .replace("AS INT)", "AS INTEGER)")))
def sql_top10(spark, sf_dir):
    register_views({"crime_aggregates": facts_table(spark, sf_dir)})
    return run_sql(spark, SQL_TOP10, cap=1000)


# ---- O4: what the canonical tables are asked beyond the reference's own texts -------------------
SQL_CUBE = """SELECT source_country, crime_category, CAST(year(period_end) AS INT) AS year,
       CAST(grouping_id(source_country, crime_category, CAST(year(period_end) AS INT)) AS INT) AS level,
       CAST(SUM(count) AS BIGINT) AS count, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM crime_aggregates WHERE suspect_dim = 'total'
GROUP BY GROUPING SETS ((source_country, crime_category, CAST(year(period_end) AS INT)),
                        (source_country, CAST(year(period_end) AS INT)), (crime_category), ())"""
# (region, year) with an even count of both categories / of the first but not of the second
SQL_BOTH = """SELECT region_code, period_start FROM crime_aggregates WHERE crime_category = 'homicide' AND count % 2 = 0
INTERSECT SELECT region_code, period_start FROM crime_aggregates WHERE crime_category = 'robbery_violent' AND count % 2 = 0"""
SQL_ONLY = SQL_BOTH.replace("INTERSECT", "EXCEPT")


def _duck_facts(text: str) -> str:
    return text.replace("crime_aggregates", "facts").replace("AS INT)", "AS INTEGER)")


def _facts_sql_query(name, text, cap=None):
    @register(name, oracle=with_ctes(SQL_FACTS, _duck_facts(text)))
    def run(spark, sf_dir):
        register_views({"crime_aggregates": facts_table(spark, sf_dir)})
        return run_sql(spark, text, cap=cap)
    return run


sql_grouping_sets = _facts_sql_query("sql_grouping_sets", SQL_CUBE)
sql_intersect = _facts_sql_query("sql_intersect", SQL_BOTH)
sql_except = _facts_sql_query("sql_except", SQL_ONLY)

SQL_CAPPED = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey;"


@register("sql_cap_cuts", oracle=SQL_CAPPED.rstrip(";") + " LIMIT 1000")
def sql_cap_cuts(spark, sf_dir):
    """A statement with more rows than the cap is cut, in its own order."""
    register_views({"orders": table(spark, sf_dir, "orders")})
    return run_sql(spark, SQL_CAPPED, cap=1000)


# ---- F11 / T3: overlapping 40-day run windows -------------------------------------------------------
@register("month_window", oracle="""
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS run_month FROM orders),
w AS (SELECT run_month, CAST(CAST(run_month || '-01' AS DATE) + INTERVAL 1 MONTH AS DATE) AS until FROM m)
SELECT w.run_month, CAST(w.until - INTERVAL 40 DAY AS DATE) AS since, w.until, COUNT(o.o_orderkey) AS n_orders
FROM w LEFT JOIN orders o ON o.o_orderdate >= CAST(w.until - INTERVAL 40 DAY AS DATE) AND o.o_orderdate < w.until
GROUP BY 1, 2, 3""")
def month_window_q(spark, sf_dir):
    """Each order falls in the window of its own month and, when late in
    the month, of the next one: explode those two candidates (bounded
    fan-out) and filter, instead of a range join."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    months = o.select(F.date_format("d", "yyyy-MM").alias("run_month")).distinct()
    cand = o.select("o_orderkey", "d", F.explode(F.array(
        F.date_format("d", "yyyy-MM"), F.date_format(F.add_months("d", 1), "yyyy-MM"))).alias("run_month"))
    since, until = month_window("run_month")
    hit = cand.filter((F.col("d") >= since) & (F.col("d") < until))
    counts = hit.groupBy("run_month").agg(F.count(F.lit(1)).alias("n_orders"))
    return (months.join(counts, "run_month", "left")
            .select("run_month", since.alias("since"), until.alias("until"),
                    F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders")))


# ---- X1-X5: one declarative spec drives the generic harmoniser -----------------------------------
ORACLE_FAMILY = with_ctes(SQL_REGION_DIM + """,
cat(native_label, crime_category) AS (VALUES """ + ", ".join(f"('{k}', '{v}')" for k, v in CATEGORY_PAIRS) + """),
rmap AS (SELECT n_nationkey AS native_code,
                'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) AS nuts_code
         FROM nation WHERE n_nationkey <> 24),
x AS (
  SELECT rm.nuts_code AS region_code, c.crime_category, CAST(year(l.l_shipdate) AS INTEGER) AS yr,
         CAST(l.l_quantity AS BIGINT) AS qty, l.l_returnflag || '|' || l.l_linestatus AS native
  FROM lineitem l JOIN cat c ON c.native_label = l.l_returnflag || '|' || l.l_linestatus
  JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN rmap rm ON rm.native_code = s.s_nationkey
),
r AS (SELECT * FROM x WHERE yr >= (SELECT max(yr) FROM x) - 2),
a AS (SELECT region_code, crime_category, yr, CAST(SUM(qty) AS BIGINT) AS count,
             array_to_string(list_slice(list_sort(list_distinct(list(native))), 1, 3), ', ') AS crime_category_native
      FROM r GROUP BY 1, 2, 3)""", """
SELECT left(a.region_code, 2) AS source_country, 'family' AS source_authority, 'tpch://lineitem' AS source_url,
       '' AS source_file_hash, TIMESTAMP '2026-01-01 00:00:00' AS retrieved_at,
       make_date(a.yr, 1, 1) AS period_start, make_date(a.yr, 12, 31) AS period_end, 'year' AS period_type,
       a.region_code, CAST(greatest(length(a.region_code) - 2, 0) AS INTEGER) AS region_level,
       a.crime_category, a.crime_category_native, 'total' AS suspect_dim, CAST(NULL AS VARCHAR) AS suspect_dim_value,
       a.count, d.population_latest AS denominator_population,
       CASE WHEN d.population_latest IS NOT NULL THEN 'region_dimension' END AS denominator_source,
       CAST(a.count AS DOUBLE) / CAST(NULLIF(d.population_latest, 0) AS DOUBLE) * 100000.0 AS rate_per_100k,
       CAST(NULL AS VARCHAR) AS notes
FROM a LEFT JOIN rdim d ON d.code = a.region_code""")
_CANON_COLS = CRIME_AGGREGATES.names


@register("adapter_family", oracle=ORACLE_FAMILY)
def adapter_family(spark, sf_dir):
    """All regions in one plan: the spec's row source is the joined line
    items; country comes from the mapped region code (X3 reads once)."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    x = li.join(s, li.l_suppkey == s.s_suppkey).select(
        "s_nationkey", F.concat_ws("|", "l_returnflag", "l_linestatus").alias("native"),
        F.col("l_quantity").cast("bigint").alias("qty"), F.year("l_shipdate").alias("yr"))
    spec = SourceSpec(country=None, authority="family", url="tpch://lineitem",
                      category_map=CATEGORY_PAIRS, native_category="native", count="qty", year="yr",
                      region="s_nationkey", region_map=region_map(spark, sf_dir),
                      retention="recent", keep_years=3)
    return harmonise(spark, x, spec, region_dim(spark, sf_dir), as_of=AS_OF)


def _family_input(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
            .select("s_nationkey", "n_regionkey", F.concat_ws("|", "l_returnflag", "l_linestatus").alias("native"),
                    F.col("l_quantity").cast("bigint").alias("qty"), F.year("l_shipdate").alias("yr")))


def _family_spec(spark, sf_dir, row_filter=None):
    return SourceSpec(country=None, authority="family", url="tpch://lineitem",
                      category_map=CATEGORY_PAIRS, native_category="native", count="qty", year="yr",
                      region="s_nationkey", region_map=region_map(spark, sf_dir),
                      retention="recent", keep_years=3, row_filter=row_filter)


@register("source_registry", oracle=ORACLE_FAMILY)
def source_registry(spark, sf_dir):
    """One source per region run in order into the canonical table
    (merge on the natural key, partition-scoped); a source whose input is
    broken is recorded as failed and the others still land."""
    landed = scratch_path(spark, "family_input")     # joined once; each source reads its own folder of it
    _family_input(spark, sf_dir).write.partitionBy("n_regionkey").parquet(landed)
    x = spark.read.parquet(landed)
    sources = [(f"region-{r}", x, _family_spec(spark, sf_dir, F.col("n_regionkey") == r)) for r in range(5)]
    sources.append(("broken", x, SourceSpec(country="ZZ", authority="x", url="x", category_map=CATEGORY_PAIRS,
                                            native_category="no_such_column", count="qty", year="yr",
                                            retention="all")))
    path = scratch_path(spark, "crime_aggregates")
    run_sources(spark, sources, region_dim(spark, sf_dir), path, as_of=AS_OF)
    return spark.read.parquet(path).select(*_CANON_COLS)
