"""Serving-view bindings: A7-A12, J9, J12, J13, W1, W4, O2, O3, F2, F21."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmoniq.functions.codes import country_of, year_end
from harmoniq.operators import views as V
from harmoniq.operators.harmonise import attach_population, canonicalise, map_values, with_rate
from harmoniq.plans import register
from harmoniq.session import materialize
from harmoniq.plans.common import (AS_OF, AUTHORITY, CATEGORY_PAIRS, SQL_FACTS,
                                   facts_table, region_dim, region_map, table, with_ctes)
from harmoniq.plans.facts_q import SQL_SUMMARY_BODY, summary
from harmoniq.schema import DERIVED_PARTS


# ---- J9 A8 F2: total / national / foreign split ------------------------------------------
def split_facts(spark, sf_dir):
    """Facts with a suspect dimension: every line counts to 'total',
    returnflag N to 'national', returnflag R on fulfilled lines to 'foreign'.
    One scan and one aggregate with a conditional sum per dimension; only
    its small result is unpivoted."""
    li = table(spark, sf_dir, "lineitem")
    sup = map_values(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
                     "s_nationkey", region_map(spark, sf_dir), "native_code", "nuts_code",
                     "region_code").select("s_suppkey", "region_code")
    cat = F.when(F.col("l_linestatus") == "F", F.lit("homicide")).otherwise(F.lit("assault_serious"))
    qty = F.col("l_quantity").cast("bigint")
    of = {"total": F.lit(True), "national": F.col("l_returnflag") == "N",
          "foreign": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")}
    x = li.join(sup, li.l_suppkey == sup.s_suppkey)
    sums = x.groupBy("region_code", cat.alias("crime_category"), F.year("l_shipdate").cast("int").alias("year")).agg(
        *[F.sum(F.when(cond, qty)).alias(dim) for dim, cond in of.items()])
    agg = (sums.unpivot(["region_code", "crime_category", "year"], list(of), "suspect_dim", "count")
           .filter("count is not null"))
    return canonicalise(agg, source_country=country_of("region_code"), source_authority=AUTHORITY,
                        source_url="tpch://lineitem", source_file_hash="",
                        retrieved_at=F.lit(str(AS_OF)).cast("timestamp_ntz"),
                        period_start=F.make_date("year", F.lit(1), F.lit(1)),
                        period_end=year_end("year"), period_type="year",
                        region_level=F.lit(1), crime_category_native=F.col("crime_category"))


SQL_SPLIT = """
rmap AS (
  SELECT n_nationkey AS native_code,
         'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) AS nuts_code
  FROM nation WHERE n_nationkey <> 24
),
x AS (
  SELECT rm.nuts_code AS region_code,
         CASE WHEN l_linestatus = 'F' THEN 'homicide' ELSE 'assault_serious' END AS crime_category,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_quantity AS BIGINT) AS qty,
         l_returnflag, l_linestatus
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN rmap rm ON rm.native_code = s.s_nationkey
),
yearly AS (
  SELECT region_code, crime_category, year, left(region_code, 2) AS country, CAST(SUM(qty) AS BIGINT) AS total,
         CAST(SUM(qty) FILTER (l_returnflag = 'N') AS BIGINT) AS national,
         CAST(SUM(qty) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS BIGINT) AS foreign_
  FROM x GROUP BY region_code, crime_category, year
)"""


@register("dimension_split_share", oracle=with_ctes(SQL_SPLIT, """
SELECT country, region_code, crime_category, total, national, foreign_ AS "foreign",
       make_date(year, 12, 31) AS period_end,
       CASE WHEN total <> 0 AND foreign_ <> 0 THEN round(100.0 * foreign_ / total, 1) END AS foreign_share_pct
FROM yearly
QUALIFY year = max(year) OVER (PARTITION BY country) AND foreign_ IS NOT NULL"""))
def dimension_split_share(spark, sf_dir):
    return V.dimension_split(split_facts(spark, sf_dir))


# ---- A9 A10 A17 ----------------------------------------------------------------------------
@register("freshness_meta", oracle=with_ctes(SQL_FACTS, """
SELECT source_country AS country, max(period_end) AS latest_period_end,
       max(retrieved_at) AS retrieved_at, COUNT(*) AS n_rows,
       COUNT(DISTINCT region_code) AS n_regions, max(source_authority) AS authority
FROM facts GROUP BY source_country"""))
def freshness_meta(spark, sf_dir):
    return V.freshness(facts_table(spark, sf_dir))


@register("country_list", oracle=with_ctes(SQL_FACTS, """
SELECT DISTINCT source_country FROM facts ORDER BY source_country"""))
def country_list(spark, sf_dir):
    return V.distinct_sorted(facts_table(spark, sf_dir), "source_country")


@register("year_span", oracle=with_ctes(SQL_FACTS, """
SELECT min(year(period_end)) AS min_year, max(year(period_end)) AS max_year FROM facts"""))
def year_span(spark, sf_dir):
    return V.year_span(facts_table(spark, sf_dir))


# ---- A11: history + derived umbrella ----------------------------------------------------------
def history_with_rollup(spark, sf_dir):
    """History rows for nations plus region-level rows that carry the
    umbrella category directly (so those are never derived)."""
    f = facts_table(spark, sf_dir)
    hist = V.history_rows(f)
    region_rows = (hist.groupBy(country_of("region_code").alias("region_code"), "yr")
                   .agg(F.sum("count").alias("count")))
    region_rows = attach_population(region_rows, region_dim(spark, sf_dir))
    region_rows = with_rate(region_rows, "count", "denominator_population", "rate").select(
        "region_code", "yr", F.lit("violent_total").alias("crime_category"), "count", "rate")
    return hist.unionByName(region_rows)


_RATES = [f"max(rate) FILTER (crime_category = '{p}')" for p in DERIVED_PARTS]
SQL_RATE_SUM = (f"CASE WHEN coalesce({', '.join(_RATES)}) IS NOT NULL THEN "
                + " + ".join(f"coalesce({r}, 0.0)" for r in _RATES) + " END")
SQL_HISTORY = f"""{SQL_FACTS},
hist0 AS (
  SELECT region_code, CAST(year(period_end) AS BIGINT) AS yr, crime_category,
         arg_max(count, (period_end, retrieved_at)) AS count,
         arg_max(rate_per_100k, (period_end, retrieved_at)) AS rate
  FROM facts WHERE suspect_dim = 'total' GROUP BY 1, 2, 3
),
rr AS (
  SELECT left(region_code, 2) AS region_code, yr, CAST(SUM(count) AS BIGINT) AS count
  FROM hist0 GROUP BY 1, 2
),
hist AS (
  SELECT * FROM hist0
  UNION ALL
  SELECT rr.region_code, rr.yr, 'violent_total', rr.count,
         CAST(rr.count AS DOUBLE) / CAST(NULLIF(d.population_latest, 0) AS DOUBLE) * 100000.0
  FROM rr LEFT JOIN rdim d ON d.code = rr.region_code
),
g AS (
  SELECT region_code, yr,
         max(CASE WHEN crime_category = 'violent_total' THEN 1 ELSE 0 END) AS has_u,
         max(CASE WHEN crime_category IN ('homicide', 'attempted_homicide', 'assault_serious',
                                          'sexual_assault', 'robbery_violent') THEN 1 ELSE 0 END) AS any_p,
         SUM(CASE WHEN crime_category IN ('homicide', 'attempted_homicide', 'assault_serious',
                                          'sexual_assault', 'robbery_violent') THEN count END) AS c,
         {SQL_RATE_SUM} AS r
  FROM hist GROUP BY 1, 2
),
hist_d AS (
  SELECT *, false AS derived FROM hist
  UNION ALL
  SELECT region_code, yr, 'violent_total', CAST(c AS BIGINT), r, true
  FROM g WHERE has_u = 0 AND any_p = 1 AND (c IS NOT NULL OR r IS NOT NULL)
)"""


def derived_history(spark, sf_dir):
    return V.with_derived_total(history_with_rollup(spark, sf_dir))


@register("derived_total", oracle=with_ctes(SQL_HISTORY, "SELECT * FROM hist_d"))
def derived_total(spark, sf_dir):
    return derived_history(spark, sf_dir)


@register("history_map")
def history_map(spark, sf_dir):
    """A12 + S18: nested {region: {year: {category: {count, rate}}}} JSON."""
    return V.nested_history(derived_history(spark, sf_dir))


# ---- J12 / J13 / W5 ------------------------------------------------------------------------
METRICS = sorted({c for _, c in CATEGORY_PAIRS} | {"violent_total"})


def asof_targets(spark, sf_dir, hist):
    """Every region code x metric x year from the first data year to five
    years past the last (generators over scalar bounds, no join)."""
    lo = hist.select(F.min("yr")).scalar()
    hi = hist.select(F.max("yr")).scalar()
    return (region_dim(spark, sf_dir).select(
        F.col("code").alias("region_code"),
        F.explode(F.array(*[F.lit(m) for m in METRICS])).alias("metric"))
        .withColumn("year", F.explode(F.sequence(lo, hi + F.lit(5)))))


SQL_TARGETS = f""",
bounds AS (SELECT min(yr) AS lo, max(yr) AS hi FROM hist_d),
targets AS (
  SELECT d.code AS region_code, m.metric, y.year
  FROM rdim d
  CROSS JOIN (VALUES {", ".join(f"('{m}')" for m in METRICS)}) m(metric)
  CROSS JOIN (SELECT unnest(range(lo, hi + 6)) AS year FROM bounds) y
),
own AS (
  SELECT t.region_code, t.year, t.metric, arg_max(h.rate, h.yr) AS rate, max(h.yr) AS found_year
  FROM targets t LEFT JOIN hist_d h
    ON h.region_code = t.region_code AND h.crime_category = t.metric
   AND h.yr BETWEEN t.year - 4 AND t.year AND h.rate IS NOT NULL
  GROUP BY 1, 2, 3
)"""


@register("asof_lookback", oracle=with_ctes(SQL_HISTORY + SQL_TARGETS, "SELECT * FROM own"))
def asof_lookback(spark, sf_dir):
    hist = materialize(derived_history(spark, sf_dir))
    targets = asof_targets(spark, sf_dir, hist)
    return V.asof_lookup(targets, hist.withColumnRenamed("crime_category", "metric").withColumnRenamed("yr", "year"),
                         "region_code", "year", "metric", "rate").select(
        "region_code", "year", "metric", "rate", F.col("found_year").cast("bigint"))


@register("asof_hierarchy", oracle=with_ctes(SQL_HISTORY + SQL_TARGETS, """
SELECT o.region_code, o.year, o.metric,
       CASE WHEN o.rate IS NULL AND left(o.region_code, 2) <> o.region_code AND p.rate IS NOT NULL
            THEN p.rate ELSE o.rate END AS rate,
       CASE WHEN o.rate IS NULL AND left(o.region_code, 2) <> o.region_code AND p.rate IS NOT NULL
            THEN p.found_year ELSE o.found_year END AS found_year,
       CASE WHEN o.rate IS NOT NULL THEN 'self'
            WHEN left(o.region_code, 2) <> o.region_code AND p.rate IS NOT NULL THEN 'country'
       END AS source_level
FROM own o LEFT JOIN own p
  ON p.region_code = left(o.region_code, 2) AND p.year = o.year AND p.metric = o.metric"""))
def asof_hierarchy(spark, sf_dir):
    hist = materialize(derived_history(spark, sf_dir))
    targets = asof_targets(spark, sf_dir, hist)
    out = V.asof_with_fallback(targets, hist.withColumnRenamed("crime_category", "metric").withColumnRenamed("yr", "year"),
                               "region_code", "year", "metric", "rate")
    return out.withColumn("found_year", F.col("found_year").cast("bigint"))


# ---- W1 / O2 / O3 / F21 ------------------------------------------------------------------------
def _summary_cte() -> str:
    return f"{SQL_FACTS.strip()},\nsummary AS ({SQL_SUMMARY_BODY.strip()})"


@register("sibling_rank", oracle=with_ctes(_summary_cte(), """
SELECT region_code, source_country, region_level, homicide_rate,
       CAST(row_number() OVER (PARTITION BY source_country, region_level
                               ORDER BY homicide_rate DESC, region_code) AS INTEGER) AS rank,
       COUNT(*) OVER (PARTITION BY source_country, region_level) AS of_n
FROM summary WHERE homicide_rate IS NOT NULL"""))
def sibling_rank(spark, sf_dir):
    s = summary(spark, sf_dir).select("region_code", "source_country", "region_level", "homicide_rate")
    return V.sibling_rank(s, "homicide_rate")


@register("top_k", oracle=with_ctes(SQL_FACTS, """
SELECT region_code, CAST(year(period_end) AS INTEGER) AS year, crime_category,
       round(rate_per_100k, 2) AS rate
FROM facts WHERE count > 0 AND rate_per_100k IS NOT NULL
ORDER BY rate_per_100k DESC, region_code, period_end, crime_category LIMIT 10"""))
def top_k(spark, sf_dir):
    f = facts_table(spark, sf_dir).filter((F.col("count") > 0) & F.col("rate_per_100k").isNotNull())
    top = V.top_k(f, [F.desc("rate_per_100k"), "region_code", "period_end", "crime_category"], 10)
    return top.select("region_code", F.year("period_end").cast("int").alias("year"),
                      "crime_category", F.round("rate_per_100k", 2).alias("rate"))


@register("first_rows", oracle=with_ctes(_summary_cte(), """
SELECT region_code, homicide_rate FROM summary
ORDER BY homicide_rate DESC NULLS LAST, region_code LIMIT 15"""))
def first_rows(spark, sf_dir):
    s = summary(spark, sf_dir)
    return V.top_k(s.select("region_code", "homicide_rate"),
                   [F.desc_nulls_last("homicide_rate"), "region_code"], 15)


# fixed values: legend stops for the class demo (rates per 100k)
STOPS = [1_000_000.0, 2_000_000.0, 4_000_000.0, 8_000_000.0]


@register("step_classes", oracle=with_ctes(_summary_cte(), f"""
SELECT region_code, homicide_rate,
       CASE WHEN homicide_rate IS NULL THEN 0
            WHEN homicide_rate >= {STOPS[3]} THEN 5
            WHEN homicide_rate >= {STOPS[2]} THEN 4
            WHEN homicide_rate >= {STOPS[1]} THEN 3
            WHEN homicide_rate >= {STOPS[0]} THEN 2 ELSE 1 END AS class
FROM summary"""))
def step_classes(spark, sf_dir):
    s = summary(spark, sf_dir).select("region_code", "homicide_rate")
    return V.step_classes(s, "homicide_rate", STOPS)


# ---- W4 -----------------------------------------------------------------------------------
@register("latest_per_group", oracle="""
WITH o AS (SELECT c.c_nationkey, o.o_orderkey, o.o_orderdate
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
l AS (SELECT c_nationkey, max(o_orderdate) AS latest_period FROM o GROUP BY 1)
SELECT o.c_nationkey, o.o_orderkey, o.o_orderdate, l.latest_period
FROM o JOIN l ON o.c_nationkey = l.c_nationkey AND o.o_orderdate = l.latest_period""")
def latest_per_group(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    x = o.join(c, o.o_custkey == c.c_custkey).select("c_nationkey", "o_orderkey", "o_orderdate")
    return V.latest_per_group(x, ["c_nationkey"], "o_orderdate")


# ---- S18 + A10: per-country JSON documents and back ---------------------------------------------
@register("summary_documents", oracle=with_ctes(_summary_cte(), """
SELECT source_country, region_code, region_level, homicide_count, homicide_rate, population FROM summary"""))
def summary_documents(spark, sf_dir):
    """Summary rows -> ordered JSON parts per country with an index (what the
    site build writes) -> read back to one row per region."""
    from harmoniq.sources import exports as X
    path, kind = _summary_parts(spark, sf_dir)
    return X.part_elements(X.read_documents(spark, path, "country"), kind).select("element.*")


@register("summary_index", oracle=with_ctes(_summary_cte(), """
SELECT source_country AS country, COUNT(*) AS elements, min(region_code) AS first_code, max(region_code) AS last_code
FROM summary GROUP BY 1"""))
def summary_index(spark, sf_dir):
    """The index of the written documents, and their first and last element."""
    from harmoniq.sources import exports as X
    path, kind = _summary_parts(spark, sf_dir)
    parts = X.part_elements(X.read_documents(spark, path, "country"), kind)
    ends = parts.groupBy("country").agg(F.min_by("element.region_code", F.struct("part", "element.region_code")).alias("first_code"),
                                        F.max_by("element.region_code", F.struct("part", "element.region_code")).alias("last_code"))
    told = spark.read.schema("country string, parts bigint, elements bigint").json(f"{path}/index")
    return told.join(ends, "country").select("country", "elements", "first_code", "last_code")


def _summary_parts(spark, sf_dir):
    from harmoniq.session import scratch_path
    from harmoniq.sources import exports as X
    s = summary(spark, sf_dir).select("source_country", "region_code", "region_level", "homicide_count",
                                      "homicide_rate", "population")
    rows = s.select(F.col("source_country").alias("country"), "region_code",
                    F.to_json(F.struct(*s.columns), X.KEEP_NULLS).alias("element"))
    path = scratch_path(spark, "summary_documents")
    X.write_documents(spark, X.document_parts(rows, "country", ["region_code"], "element", part_bytes=512), "country", path)
    return path, s.schema


@register("history_map_parsed", oracle=with_ctes(SQL_HISTORY, """
SELECT region_code, yr, crime_category, count, rate FROM hist_d"""))
def history_map_parsed(spark, sf_dir):
    """The nested {region: {year: {category: {count, rate}}}} documents
    parsed back into rows."""
    docs = history_map(spark, sf_dir)
    m = F.from_json("history_json", "map<string, map<string, struct<count:bigint, rate:double>>>")
    y = docs.select("region_code", F.explode(m).alias("yr", "cats"))
    c = y.select("region_code", F.col("yr").cast("bigint").alias("yr"), F.explode("cats").alias("crime_category", "v"))
    return c.select("region_code", "yr", "crime_category", F.col("v.count").alias("count"),
                    F.col("v.rate").alias("rate"))
