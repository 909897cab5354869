"""Harmonisation bindings: J1-J5, A1-A6, F1, P11-P15, P18, flagship summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmoniq.functions.text import fold_key
from harmoniq.operators.harmonise import (attach_population, denominator_fallback, keep_complete_years,
                                          keep_latest, keep_recent, literal_map, prefer_unit,
                                          quarters_to_years, two_pass_lookup, with_rate)
from harmoniq.operators.views import latest_summary
from harmoniq.plans import register
from harmoniq.plans.common import (SQL_FACTS, SQL_REGION_DIM, SQL_YEARLY, facts, facts_table, region_dim,
                                   table, with_ctes, yearly_counts)


# ---- J1 J2 A1 A2 J4 F1 ---------------------------------------------------------------
@register("harmonise_counts", oracle=with_ctes(SQL_REGION_DIM + ",\n" + SQL_YEARLY, """
SELECT y.region_code, y.crime_category, y.year, y.count, y.crime_category_native,
       d.population_latest AS denominator_population,
       CAST(y.count AS DOUBLE) / CAST(NULLIF(d.population_latest, 0) AS DOUBLE) * 100000.0 AS rate_per_100k
FROM yearly y LEFT JOIN rdim d ON d.code = y.region_code"""), headline=True)
def harmonise_counts(spark, sf_dir):
    agg = attach_population(yearly_counts(spark, sf_dir), region_dim(spark, sf_dir))
    return with_rate(agg)


# ---- P15 P18 J4 F1: full canonical rows ------------------------------------------------
@register("canonical_facts", oracle=with_ctes(SQL_FACTS, "SELECT * FROM facts"))
def canonical_facts(spark, sf_dir):
    return facts(spark, sf_dir)


# ---- flagship: J8 A7 J10 O1 --------------------------------------------------------------
_SUMMARY_CATEGORIES = [("homicide", "homicide"), ("violent_total", "violent_total"), ("assault_serious", "assault"),
                       ("robbery_violent", "robbery"), ("sexual_assault", "sexual_assault")]
_PIVOT = ",\n  ".join(f"max({value}) FILTER (crime_category = '{cat}') AS {name}_{suffix}"
                      for cat, name in _SUMMARY_CATEGORIES
                      for value, suffix in (("count", "count"), ("rate_per_100k", "rate")))
# the rows of a country's last period, pivoted by category, with the region's name
SQL_SUMMARY_BODY = f"""
SELECT source_country, region_code, region_level,
  {_PIVOT},
  max(denominator_population) AS population, max(period_start) AS period_start,
  max(period_end) AS period_end, max(source_url) AS source_url,
  (SELECT any_value(name_en) FROM rdim WHERE code = region_code) AS region_name
FROM (SELECT *, max(period_end) OVER (PARTITION BY source_country) AS last_period
      FROM facts WHERE suspect_dim = 'total')
WHERE period_end = last_period
GROUP BY source_country, region_code, region_level"""


def summary(spark, sf_dir, fresh: bool = False):
    """Latest-period summary.  ``fresh`` builds the fact table from the
    line items in the same plan (the flagship query, end to end); the other
    views read the materialized fact table."""
    f = facts(spark, sf_dir) if fresh else facts_table(spark, sf_dir)
    return latest_summary(f, region_dim(spark, sf_dir))


@register("latest_summary_pivot", oracle=f"WITH {SQL_FACTS.strip()}{SQL_SUMMARY_BODY}", headline=True)
def latest_summary_pivot(spark, sf_dir):
    return summary(spark, sf_dir, fresh=True)


# ---- P11 / P12: retention relative to the data's own max --------------------------------
def _orders_by_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("int").alias("year"), "o_orderpriority")


@register("recent_years", oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, COUNT(*) AS n_orders
FROM orders
WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) FROM orders) - 2
GROUP BY 1, 2""")
def recent_years(spark, sf_dir):
    rows = keep_recent(_orders_by_year(spark, sf_dir), "year", 3)
    return rows.groupBy("year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


@register("latest_only", oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, COUNT(*) AS n_orders
FROM orders
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
GROUP BY 1, 2""")
def latest_only(spark, sf_dir):
    rows = keep_latest(_orders_by_year(spark, sf_dir), "year")
    return rows.groupBy("year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


# ---- A4 P13 -------------------------------------------------------------------------------
@register("latest_complete_year", oracle="""
WITH q AS (
  SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(quarter(o_orderdate) AS INTEGER) AS quarter, 1 AS cnt
  FROM orders
),
y AS (
  SELECT o_orderpriority, year, CAST(SUM(cnt) AS BIGINT) AS count,
         CAST(COUNT(DISTINCT quarter) AS BIGINT) AS quarters
  FROM q GROUP BY 1, 2
),
lc AS (SELECT max(year) AS ly FROM y WHERE quarters = 4)
SELECT y.* FROM y, lc WHERE y.year <= lc.ly AND y.year > lc.ly - 10""")
def latest_complete_year(spark, sf_dir):
    q = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.year("o_orderdate").cast("int").alias("year"),
        F.quarter("o_orderdate").cast("int").alias("quarter"), F.lit(1).alias("cnt"))
    annual = quarters_to_years(q, ["o_orderpriority"], "year", "quarter", count="cnt")
    return keep_complete_years(annual, "year", "quarters", 10)


# ---- P14 A6 ------------------------------------------------------------------------------
UNIT_SQL = "CASE WHEN p_type = 'ECONOMY' AND p_size >= 48 THEN 'Victime' ELSE 'Infraction' END"


@register("unit_preference", oracle=f"""
WITH u AS (SELECT p_brand, {UNIT_SQL} AS unit FROM part),
h AS (SELECT p_brand, max(CASE WHEN unit = 'Victime' THEN 1 ELSE 0 END) AS has_pref,
             list_sort(list_distinct(list(unit))) AS units_seen FROM u GROUP BY p_brand)
SELECT u.p_brand, u.unit, h.units_seen, COUNT(*) AS n_parts
FROM u JOIN h ON u.p_brand = h.p_brand
WHERE u.unit = CASE WHEN h.has_pref = 1 THEN 'Victime' ELSE 'Infraction' END
GROUP BY u.p_brand, u.unit, h.units_seen""")
def unit_preference(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", F.expr(UNIT_SQL).alias("unit"))
    kept = prefer_unit(p, "p_brand", "unit", "Victime", "Infraction")
    return kept.groupBy("p_brand", "unit", "units_seen").agg(F.count(F.lit(1)).alias("n_parts"))


# ---- J5 ---------------------------------------------------------------------------------
# fixed values: nations whose dimension population is withheld (NULL) or zero
POP_NULL_NATIONS = (3, 7)
POP_ZERO_NATIONS = (11,)


@register("denominator_fallback", oracle=f"""
WITH cp AS (SELECT c_nationkey AS k, COUNT(*) AS pop FROM customer GROUP BY 1),
sp AS (SELECT s_nationkey AS k, COUNT(*) * 1000 AS pop FROM supplier GROUP BY 1),
x AS (
  SELECT n.n_nationkey,
         CAST(CASE WHEN n.n_nationkey IN {POP_NULL_NATIONS} THEN NULL
                   WHEN n.n_nationkey IN ({POP_ZERO_NATIONS[0]}) THEN 0 ELSE cp.pop END AS BIGINT) AS dim_pop,
         CAST(sp.pop AS BIGINT) AS src_pop
  FROM nation n LEFT JOIN cp ON cp.k = n.n_nationkey LEFT JOIN sp ON sp.k = n.n_nationkey
)
SELECT n_nationkey, dim_pop, src_pop,
       COALESCE(NULLIF(dim_pop, 0), NULLIF(src_pop, 0)) AS denominator_population,
       CASE WHEN NULLIF(dim_pop, 0) IS NOT NULL THEN 'dimension'
            WHEN NULLIF(src_pop, 0) IS NOT NULL THEN 'source' END AS denominator_source
FROM x""")
def denominator_fallback_q(spark, sf_dir):
    cp = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("cpop"))
    sp = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k2")).agg(
        (F.count(F.lit(1)) * 1000).alias("spop"))
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    x = (n.join(cp, n.n_nationkey == cp.k, "left").join(sp, n.n_nationkey == sp.k2, "left")
         .select("n_nationkey",
                 F.when(F.col("n_nationkey").isin(*POP_NULL_NATIONS), F.lit(None))
                 .when(F.col("n_nationkey").isin(*POP_ZERO_NATIONS), F.lit(0))
                 .otherwise(F.col("cpop")).cast("bigint").alias("dim_pop"),
                 F.col("spop").cast("bigint").alias("src_pop")))
    value, label = denominator_fallback("dim_pop", "src_pop", "dimension", "source")
    return x.select("n_nationkey", "dim_pop", "src_pop", value.alias("denominator_population"),
                    label.alias("denominator_source"))


# ---- J3 F5 --------------------------------------------------------------------------------
# fixed values: alias table (accented, lower-case alias -> region code)
ALIASES = [
    ("Nación Cero", "R0A"),
    ("Nación Uno", "R1B"),
    ("Nación Dos", "R2C"),
    ("Nación Tres", "R3D"),
    ("Nación Cuatro", "R4E"),
]
ALIAS_WORDS = ("Cero", "Uno", "Dos", "Tres", "Cuatro")


def _native_name_sql():
    words = ", ".join(f"'{w}'" for w in ALIAS_WORDS)
    return f"""CASE c.c_mktsegment
      WHEN 'AUTOMOBILE' THEN n.n_name
      WHEN 'BUILDING' THEN '  ' || replace(replace(n.n_name, 'A', 'Á'), 'N', 'Ñ')
      WHEN 'FURNITURE' THEN 'nacion ' || lower([{words}][n.n_nationkey + 1])
      WHEN 'HOUSEHOLD' THEN 'NACIÓN ' || upper([{words}][n.n_nationkey + 1])
      ELSE 'Atlantis ' || CAST(n.n_nationkey AS VARCHAR) END"""


@register("alias_lookup", oracle=f"""
WITH direct AS (
  SELECT lower(trim(strip_accents(n_name))) AS k,
         'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) AS code FROM nation),
alias(a, code) AS (VALUES {", ".join(f"('{a}', '{c}')" for a, c in ALIASES)}),
al AS (SELECT lower(trim(strip_accents(a))) AS k, code FROM alias),
src AS (
  SELECT c.c_custkey, {_native_name_sql()} AS native_name
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
)
SELECT s.c_custkey, s.native_name, COALESCE(d.code, al.code) AS region_code
FROM src s
LEFT JOIN direct d ON d.k = lower(trim(strip_accents(s.native_name)))
LEFT JOIN al ON al.k = lower(trim(strip_accents(s.native_name)))""")
def alias_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    words = F.array(*[F.lit(w) for w in ALIAS_WORDS])
    word = F.try_element_at(words, (F.col("n_nationkey") + 1).cast("int"))
    native = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.col("n_name"))
              .when(F.col("c_mktsegment") == "BUILDING",
                    F.concat(F.lit("  "), F.replace(F.replace("n_name", F.lit("A"), F.lit("Á")),
                                                    F.lit("N"), F.lit("Ñ"))))
              .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("nacion "), F.lower(word)))
              .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("NACIÓN "), F.upper(word)))
              .otherwise(F.concat(F.lit("Atlantis "), F.col("n_nationkey").cast("string"))))
    src = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", native.alias("native_name"))
    direct = n.select("n_name", F.concat(F.lit("R"), F.col("n_regionkey").cast("string"),
                                         F.char(F.lit(65) + F.col("n_nationkey"))).alias("code"))
    aliases = literal_map(spark, ALIASES, "alias", "code")
    return two_pass_lookup(src, "native_name", direct, aliases, "region_code", fold_key)


# ---- A3 / A5 --------------------------------------------------------------------------------
@register("collapse_subdim", oracle="""
SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count
FROM lineitem GROUP BY 1, 2""")
def collapse_subdim(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_returnflag", F.year("l_shipdate").cast("int").alias("year"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count")))


@register("group_max", oracle="""
SELECT p_brand, max(p_retailprice) AS max_price, max(p_size) AS max_size FROM part GROUP BY 1""")
def group_max(spark, sf_dir):
    return (table(spark, sf_dir, "part").groupBy("p_brand")
            .agg(F.max("p_retailprice").alias("max_price"), F.max("p_size").alias("max_size")))
