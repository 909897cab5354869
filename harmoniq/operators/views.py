"""Serving views over canonical facts: pivots, splits, freshness, derived
totals, as-of lookups with hierarchical fallback, ranks and top-k.

All functions take canonical-shaped DataFrames and return lazy DataFrames.
"Latest" over raw rows is a grouped max joined back (partial aggregation,
one row per group), so a group holding a third of all rows is never one
task; over the aggregated fact table a window max is used instead (its
per-country partition is bounded by regions x categories x periods) so the
fact plan is evaluated once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harmoniq.functions.codes import country_of
from harmoniq.functions.metrics import share_pct, step_bucket
from harmoniq.schema import DERIVED_PARTS

# fixed values: summary pivot columns (category -> column prefix)
SUMMARY_CATEGORIES = (
    ("homicide", "homicide"),
    ("violent_total", "violent_total"),
    ("assault_serious", "assault"),
    ("robbery_violent", "robbery"),
    ("sexual_assault", "sexual_assault"),
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# W4 / J9 ---------------------------------------------------------------------
def latest_per_group(df: DataFrame, group: list[str], period: str = "period_end",
                     out: str = "latest_period", method: str = "join") -> DataFrame:
    """Rows whose period equals the group's max period.

    ``method='join'`` (raw rows): the per-group max is a partial aggregate
    (one row per group, broadcast by AQE) joined back on equality, so a hot
    group is never one task.  ``method='window'`` (already aggregated input
    such as the canonical fact table, whose per-country partition is bounded
    by regions x categories x periods): one pass, no second evaluation of the
    input plan."""
    if method == "window":
        from pyspark.sql import Window
        w = Window.partitionBy(*group)
        return df.withColumn(out, F.max(period).over(w)).filter(F.col(period) == F.col(out))
    latest = df.groupBy(*group).agg(F.max(period).alias(out))
    return df.join(latest, [*group], "inner").filter(F.col(period) == F.col(out))


# A7 + J8 + J10 + O1 ------------------------------------------------------------------
def latest_summary(facts: DataFrame, regions: DataFrame,
                   categories=SUMMARY_CATEGORIES) -> DataFrame:
    """Latest-period regional summary per country: one row per region with
    count/rate per category, population and period, region name attached,
    ordered by homicide rate descending, NULLs last."""
    base = facts.filter(F.col("suspect_dim") == "total")
    aggs = []
    for cat, name in categories:
        aggs.append(F.max(F.when(F.col("crime_category") == cat, F.col("count"))).alias(f"{name}_count"))
        aggs.append(F.max(F.when(F.col("crime_category") == cat, F.col("rate_per_100k"))).alias(f"{name}_rate"))
    aggs += [F.max("denominator_population").alias("population"),
             F.max("period_start").alias("period_start"),
             F.max("source_url").alias("source_url")]
    # one row per region and period first: the window over a country sees no fact rows
    wide = base.groupBy("source_country", "region_code", "region_level", "period_end").agg(*aggs)
    wide = latest_per_group(wide, ["source_country"], "period_end", "__pe", method="window").drop("__pe")
    names = regions.select(F.col("code").alias("__code"), F.col("name_en").alias("region_name"))
    out = wide.join(names, wide.region_code == names.__code, "left").drop("__code")
    return out.orderBy(F.desc_nulls_last("homicide_rate"), "region_code")


# A8 + F2 ---------------------------------------------------------------------------
def dimension_split(facts: DataFrame, dims=("total", "national", "foreign")) -> DataFrame:
    """Per country's latest period: total/national/foreign counts side by
    side, only where a foreign count exists (HAVING), with the foreign share."""
    base = facts.filter(F.col("suspect_dim").isin(*dims))
    wide = (base.groupBy("source_country", "region_code", "crime_category", "period_end")
            .agg(*[F.max(F.when(F.col("suspect_dim") == d, F.col("count"))).alias(d) for d in dims]))
    wide = (latest_per_group(wide, ["source_country"], "period_end", "__pe", method="window")
            .filter(F.col("foreign").isNotNull())
            .select("source_country", "region_code", "crime_category", *dims, "period_end"))
    return (wide.withColumnRenamed("source_country", "country")
            .withColumn("foreign_share_pct", share_pct("foreign", "total")))


# A9 / A10 / A17 ------------------------------------------------------------------------
def freshness(facts: DataFrame) -> DataFrame:
    """Per-country freshness metadata (exact distinct count)."""
    return (facts.groupBy(F.col("source_country").alias("country"))
            .agg(F.max("period_end").alias("latest_period_end"),
                 F.max("retrieved_at").alias("retrieved_at"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("region_code").alias("n_regions"),
                 F.max("source_authority").alias("authority")))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def year_span(df: DataFrame, period: str = "period_end") -> DataFrame:
    y = F.year(period).cast("bigint")
    return df.agg(F.min(y).alias("min_year"), F.max(y).alias("max_year"))


# A11 ----------------------------------------------------------------------------------
def history_rows(facts: DataFrame) -> DataFrame:
    """(region_code, yr, crime_category, count, rate) for suspect_dim total.
    When several rows share the key the newest (period_end, retrieved_at)
    wins, so the result is deterministic."""
    base = facts.filter(F.col("suspect_dim") == "total").withColumn(
        "yr", F.year("period_end").cast("bigint"))
    pick = F.struct("period_end", "retrieved_at")
    return (base.groupBy("region_code", "yr", "crime_category")
            .agg(F.max_by("count", pick).alias("count"),
                 F.max_by("rate_per_100k", pick).alias("rate")))


def with_derived_total(history: DataFrame, parts=DERIVED_PARTS, umbrella: str = "violent_total") -> DataFrame:
    """Where a (region, year) lacks the umbrella category, add it as the sum
    of the parts present; count NULL when no part had a count, same for the
    rate; flagged ``derived``.  A part occurs once per region and year, so its
    maximum is its value, and adding the parts in their fixed order makes the
    rate independent of the order of rows."""
    is_part = F.col("crime_category").isin(*parts)
    rates = [F.max(F.when(F.col("crime_category") == p, F.col("rate"))) for p in parts]
    summed = reduce(lambda a, b: a + b, [F.coalesce(r, F.lit(0.0)) for r in rates])
    g = (history.groupBy("region_code", "yr")
         .agg(F.max((F.col("crime_category") == umbrella).cast("int")).alias("__has"),
              F.sum(F.when(is_part, F.col("count"))).alias("count"),
              F.when(F.coalesce(*rates).isNotNull(), summed).alias("rate"),
              F.max(is_part.cast("int")).alias("__any")))
    derived = (g.filter((F.col("__has") == 0) & (F.col("__any") == 1)
                        & (F.col("count").isNotNull() | F.col("rate").isNotNull()))
               .select("region_code", "yr", F.lit(umbrella).alias("crime_category"),
                       F.col("count").cast("bigint").alias("count"), "rate",
                       F.lit(True).alias("derived")))
    return history.withColumn("derived", F.lit(False)).unionByName(derived)


# A12 / S18 --------------------------------------------------------------------------
def nested_history(history: DataFrame) -> DataFrame:
    """{region: {year: {category: {count, rate}}}} as one JSON document per
    region, years and categories in order, nulls kept; derived entries carry
    ``derived: true`` (a region's entries are bounded by years x categories)."""
    keep = {"ignoreNullFields": "false"}
    flag = F.col("derived") if "derived" in history.columns else F.lit(False)
    entry = F.when(flag, F.to_json(F.struct("count", "rate", F.lit(True).alias("derived")), keep)) \
             .otherwise(F.to_json(F.struct("count", "rate"), keep))
    members = lambda key, value: F.concat(F.lit("{"), F.array_join(F.transform(     # noqa: E731
        F.array_sort(F.collect_list(F.struct(F.to_json(F.array(key)).alias("k"), value.alias("v")))),
        lambda m: F.concat(m["k"].substr(F.lit(2), F.length(m["k"]) - 2), F.lit(":"), m["v"])), ","), F.lit("}"))
    per_year = history.withColumn("__e", entry).groupBy("region_code", "yr").agg(
        members(F.col("crime_category"), F.col("__e")).alias("cats"))
    return per_year.groupBy("region_code").agg(
        members(F.col("yr").cast("string"), F.col("cats")).alias("history_json"))


# J12 / J13 / W5 ------------------------------------------------------------------------
def asof_lookup(targets: DataFrame, history: DataFrame, key: str, year: str, metric: str,
                value: str, tolerance: int = 4) -> DataFrame:
    """Value at year y, else y-1 ... y-tolerance, skipping NULL values.

    Range join rewritten as an equi-join: each target explodes into
    tolerance+1 candidate years (bounded fan-out), joined on (key, year,
    metric); the closest hit wins with ``min_by(value, offset)``."""
    hist = history.filter(F.col(value).isNotNull()).select(
        F.col(key).alias("__k"), F.col(year).alias("__y"), F.col(metric).alias("__m"),
        F.col(value).alias("__v"))
    t = targets.withColumn("__off", F.explode(F.sequence(F.lit(0), F.lit(tolerance))))
    t = t.withColumn("__ly", F.col(year) - F.col("__off"))
    j = t.join(hist, (t[key] == hist.__k) & (t["__ly"] == hist.__y) & (t[metric] == hist.__m), "left")
    return (j.groupBy(key, year, metric)
            .agg(F.min_by("__v", F.when(F.col("__v").isNotNull(), F.col("__off"))).alias(value),
                 F.max(F.when(F.col("__v").isNotNull(), F.col("__ly"))).alias("found_year")))


def asof_with_fallback(targets: DataFrame, history: DataFrame, key: str, year: str,
                       metric: str, value: str, tolerance: int = 4) -> DataFrame:
    """Targets with no own as-of value fall back to the as-of value of
    their 2-character country code; ``source_level`` says which was used."""
    own = asof_lookup(targets, history, key, year, metric, value, tolerance)
    cc = targets.select(country_of(key).alias("__cc"), year, metric).distinct()
    parent = asof_lookup(cc.withColumnRenamed("__cc", key), history, key, year, metric,
                         value, tolerance).select(
        F.col(key).alias("__cc"), F.col(year).alias("__yr"), F.col(metric).alias("__mt"),
        F.col(value).alias("__pv"), F.col("found_year").alias("__pf"))
    j = own.join(parent, (country_of(own[key]) == parent.__cc) & (own[year] == parent.__yr)
                 & (own[metric] == parent.__mt), "left")
    use_parent = F.col(value).isNull() & (country_of(key) != F.col(key)) & F.col("__pv").isNotNull()
    return j.select(
        key, year, metric,
        F.when(use_parent, F.col("__pv")).otherwise(F.col(value)).alias(value),
        F.when(use_parent, F.col("__pf")).otherwise(F.col("found_year")).alias("found_year"),
        F.when(F.col(value).isNotNull(), F.lit("self"))
         .when(use_parent, F.lit("country")).alias("source_level"))


# W1 -------------------------------------------------------------------------------
def sibling_rank(summary: DataFrame, value: str, group=("source_country", "region_level"),
                 tie: str = "region_code") -> DataFrame:
    """Position among same-country, same-level siblings by value desc (NULLs
    excluded), ties broken by code; plus the number of ranked siblings.
    Runs on the per-region summary, whose partitions are bounded by the
    number of regions in a country, not by fact rows."""
    ranked = summary.filter(F.col(value).isNotNull())
    w = Window.partitionBy(*group).orderBy(F.desc(value), F.asc(tie))
    return (ranked.withColumn("rank", F.row_number().over(w))
            .withColumn("of_n", F.count(F.lit(1)).over(Window.partitionBy(*group))))


# O2 / O3 / F21 ------------------------------------------------------------------------
def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k -> TakeOrderedAndProject (per-task top-k, then
    merge of k-row lists; no full sort)."""
    return df.orderBy(*order).limit(k)


def step_classes(df: DataFrame, value: str, stops: list[float], out: str = "class") -> DataFrame:
    """F21 legend classes: NULL -> 0 (grey), below stops[0] -> 1, then one
    class per stop passed."""
    outputs = list(range(2, len(stops) + 2))
    cls = step_bucket(value, stops, outputs, 1)
    return df.withColumn(out, F.when(F.col(value).isNull(), F.lit(0)).otherwise(cls))


def top_of_group(df: DataFrame, group: list[str], measure: Column, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the greatest ``measure`` (ties: least
    ``tie``, which is unique in a group), with their ``place`` from 1.  Rows are
    first reduced to n per group and salt, so no group is sorted in one task."""
    salted = df.withColumn("__m", measure).withColumn("__salt", F.pmod(F.xxhash64(tie), F.lit(64)))
    by = [F.desc("__m"), F.asc(tie)]
    first = Window.partitionBy(*group, "__salt").orderBy(*by)
    few = salted.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= n)
    last = Window.partitionBy(*group).orderBy(*by)
    return (few.withColumn("place", F.row_number().over(last)).filter(F.col("place") <= n)
            .drop("__m", "__salt", "__n"))
