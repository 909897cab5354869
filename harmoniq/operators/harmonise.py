"""Tier-1 harmonisation: native categories/regions -> canonical long facts.

Every function is ``DataFrame -> DataFrame`` and lazy.  Lookup tables are
joined without a broadcast hint unless they are literal tables built from
code (bounded by construction, see :func:`lookup_side`); for data-derived
dimensions AQE measures the runtime size and picks broadcast-hash below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and sort-merge above it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.codes import country_of, level_of, year_end, year_start
from harmoniq.functions.metrics import rate_per_100k
from harmoniq.functions.text import lenient_long
from harmoniq.schema import CRIME_AGGREGATES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_literal(df: DataFrame) -> bool:
    """True for tables built from rows written in code (bounded by code)."""
    return bool(getattr(df, "_harmoniq_literal", False))


def lookup_side(df: DataFrame, literal: bool | None = None) -> DataFrame:
    """Broadcast a lookup only when its size is proven small: literal rows
    from code.  Anything read from storage is left to AQE's runtime size
    check (broadcast below the threshold, sort-merge above)."""
    small = is_literal(df) if literal is None else literal
    return F.broadcast(df) if small else df


def literal_map(spark: SparkSession, pairs, key: str = "native",
                value: str = "mapped", key_type: str = "string",
                value_type: str = "string") -> DataFrame:
    """A mapping dimension from literal (key, value) pairs."""
    schema = T.StructType.fromDDL(f"`{key}` {key_type}, `{value}` {value_type}")
    return literal_table(spark, list(pairs), schema)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows from code as a LocalRelation (the pandas path keeps it local, so
    the planner knows its size and it can be broadcast safely)."""
    import pandas as pd
    pdf = pd.DataFrame.from_records(rows, columns=[f.name for f in schema.fields])
    for f in schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.LongType)):
            pdf[f.name] = pdf[f.name].astype("Int64")
        elif isinstance(f.dataType, T.StringType):
            pdf[f.name] = pdf[f.name].astype(object)
    df = spark.createDataFrame(pdf, schema)
    df._harmoniq_literal = True
    return df


# J1 / J2 -------------------------------------------------------------------
def map_values(df: DataFrame, native: str | Column, mapping: DataFrame,
               map_key: str, map_value: str, out: str, key_fn=None) -> DataFrame:
    """Inner equi-join to a mapping dimension: unmapped rows are dropped,
    never defaulted.  ``key_fn`` normalises both sides (e.g. lower/trim)."""
    key_fn = key_fn or (lambda c: c)
    m = mapping.select(key_fn(F.col(map_key)).alias("__mk"), F.col(map_value).alias(out))
    joined = df.join(lookup_side(m, is_literal(mapping)), key_fn(_c(native)) == F.col("__mk"), "inner")
    return joined.drop("__mk")


# J3 --------------------------------------------------------------------------
def two_pass_lookup(df: DataFrame, name: str, direct: DataFrame, aliases: DataFrame,
                    out: str, key_fn) -> DataFrame:
    """Fuzzy-normalised lookup: normalised name against the direct table,
    then against an alias table; NULL when neither matches (left joins, so
    the caller decides whether to drop).  ``direct`` is (name, code),
    ``aliases`` is (alias, code)."""
    d = direct.select(key_fn(F.col(direct.columns[0])).alias("__k1"),
                      F.col(direct.columns[1]).alias("__c1"))
    a = aliases.select(key_fn(F.col(aliases.columns[0])).alias("__k2"),
                       F.col(aliases.columns[1]).alias("__c2"))
    k = key_fn(F.col(name))
    res = (df.withColumn("__k", k)
           .join(lookup_side(d, is_literal(direct)), F.col("__k") == F.col("__k1"), "left")
           .join(lookup_side(a, is_literal(aliases)), F.col("__k") == F.col("__k2"), "left"))
    return res.withColumn(out, F.coalesce("__c1", "__c2")).drop("__k", "__k1", "__c1", "__k2", "__c2")


# J4 / J5 -------------------------------------------------------------------
def attach_population(df: DataFrame, regions: DataFrame, code_col: str = "region_code",
                      dim_code: str = "code", dim_pop: str = "population_latest",
                      out: str = "denominator_population") -> DataFrame:
    """Left join of the region dimension's population (NULL when missing)."""
    dim = regions.select(F.col(dim_code).alias("__code"), F.col(dim_pop).cast("bigint").alias(out))
    return (df.join(lookup_side(dim, is_literal(regions)), F.col(code_col) == F.col("__code"), "left")
            .drop("__code"))


def denominator_fallback(dim_pop, src_pop, dim_label: str, src_label: str) -> tuple[Column, Column]:
    """Dimension population unless NULL/0, else the source's own; the
    label follows the value used (NULL when neither)."""
    d = F.nullif(_c(dim_pop).cast("bigint"), F.lit(0))
    s = F.nullif(_c(src_pop).cast("bigint"), F.lit(0))
    value = F.coalesce(d, s)
    label = F.when(d.isNotNull(), F.lit(dim_label)).when(s.isNotNull(), F.lit(src_label))
    return value, label


# A1 / A2 / A3 / A5 / A6 --------------------------------------------------------
def native_examples(label, n: int = 3) -> Column:
    """A2: first ``n`` of the sorted distinct labels, joined by ', '.  The
    labels reaching it have passed the inner join with the category map, so
    the set per group is bounded by that map's keys (partial sets are merged
    map-side)."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(_c(label))), 1, n), ", ")


def sum_counts(df: DataFrame, keys: list[str], count: str = "count",
               native: str | None = None, extra_aggs: list[Column] | None = None) -> DataFrame:
    """A1 (+A2): sum of counts per key; partial aggregation happens map-side
    so hot keys are pre-reduced before the shuffle.  A count that is not a
    number counts as zero, not as an error (P6)."""
    aggs = [F.sum(lenient_long(count)).alias("count")]
    if native:
        aggs.append(native_examples(native).alias("crime_category_native"))
    aggs += extra_aggs or []
    return df.groupBy(*keys).agg(*aggs)


def quarters_to_years(df: DataFrame, keys: list[str], year: str, quarter: str,
                      count: str = "count") -> DataFrame:
    """A4: yearly sums with the number of distinct quarters seen."""
    return (df.groupBy(*keys, year)
            .agg(F.sum(F.col(count).cast("bigint")).alias("count"),
                 F.count_distinct(quarter).cast("bigint").alias("quarters")))


# P11 / P12 / P13 -----------------------------------------------------------------
def keep_recent(df: DataFrame, period: str, n: int) -> DataFrame:
    """Keep periods >= max(period) - (n - 1).  The max is a scalar
    subquery (partial max per task, one row), not a window over all rows."""
    mx = df.select(F.max(period)).scalar()
    return df.filter(F.col(period) >= mx - F.lit(n - 1))


def keep_latest(df: DataFrame, period: str) -> DataFrame:
    """Keep only the latest period."""
    return df.filter(F.col(period) == df.select(F.max(period)).scalar())


def keep_complete_years(df: DataFrame, year: str = "year", quarters: str = "quarters",
                        span: int = 10) -> DataFrame:
    """Keep years up to the latest year in which some group has all four
    quarters, and at most ``span`` years back from it.  Older incomplete
    years are kept."""
    latest = df.filter(F.col(quarters) == 4).select(F.max(year)).scalar()
    return df.filter((F.col(year) <= latest) & (F.col(year) > latest - F.lit(span)))


def prefer_unit(df: DataFrame, indicator: str, unit: str, preferred: str, fallback: str) -> DataFrame:
    """Per indicator keep the preferred unit if it occurs, else the
    fallback.  Computed with a grouped aggregate + join (partial agg is
    skew-safe) rather than a window over a possibly hot indicator."""
    has = df.groupBy(indicator).agg(
        F.max((F.col(unit) == preferred).cast("int")).alias("__has_pref"),
        F.array_sort(F.collect_set(unit)).alias("units_seen"))
    return (df.join(has, indicator, "inner")
            .filter(F.col(unit) == F.when(F.col("__has_pref") == 1, F.lit(preferred))
                    .otherwise(F.lit(fallback)))
            .drop("__has_pref"))


# P18 -----------------------------------------------------------------------------
def canonicalise(df: DataFrame, **consts) -> DataFrame:
    """Project onto the 19-column crime_aggregates schema in canonical order.
    Columns missing from ``df`` come from ``consts`` (literal or Column),
    else NULL; every column is cast to its canonical type."""
    cols = []
    for f in CRIME_AGGREGATES.fields:
        if f.name in consts:
            v = consts[f.name]
            expr = v if isinstance(v, Column) else F.lit(v)
        elif f.name in df.columns:
            expr = F.col(f.name)
        else:
            expr = F.lit(None)
        cols.append(expr.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def with_rate(df: DataFrame, count: str = "count", pop: str = "denominator_population",
              out: str = "rate_per_100k") -> DataFrame:
    return df.withColumn(out, rate_per_100k(count, pop))


# Declarative source spec ----------------------------------------------------
@dataclass
class SourceSpec:
    """What differs between sources, as data (one generic harmoniser
    replaces per-country normalise code).  ``country=None`` derives the
    country from the mapped region code, so one spec can cover many
    countries in one plan (the file is read once, grouped by country)."""
    country: str | None
    authority: str
    url: str
    category_map: list[tuple[str, str]]
    native_category: str
    count: str
    year: str
    region: str | None = None            # native region column; None -> country level
    region_map: DataFrame | None = None  # (native, code)
    region_key_fn: object = None
    group_extra: list[str] = field(default_factory=list)
    retention: str | None = None         # "recent" | "latest" | "all": must be stated
    keep_years: int | None = None        # with "recent"
    row_filter: Column | None = None

    def __post_init__(self):
        if self.retention not in ("recent", "latest", "all") or (self.retention == "recent") != (self.keep_years is not None):
            raise ValueError("state the retention: recent (with keep_years), latest or all")


def harmonise(spark: SparkSession, df: DataFrame, spec: SourceSpec, regions: DataFrame,
              as_of=None, file_hash: str = "") -> DataFrame:
    """Generic normalise: filter -> map category (J1) -> map region (J2) ->
    sum + native examples (A1/A2) -> retention on the aggregate (P11/P12)
    -> population (J4) -> rate (F1) -> canonical projection (P18).  A row
    whose year is not a number belongs to no period and goes."""
    if spec.row_filter is not None:
        df = df.filter(spec.row_filter)
    cat = literal_map(spark, spec.category_map, "__native", "crime_category")
    df = map_values(df, spec.native_category, cat, "__native", "crime_category", "crime_category")
    if spec.region is not None and spec.region_map is not None:
        rm = spec.region_map
        # mapping files carry (native_code, native_name, nuts_code, notes);
        # two-column maps are (native, code)
        key = "native_code" if "native_code" in rm.columns else rm.columns[0]
        value = "nuts_code" if "nuts_code" in rm.columns else rm.columns[1]
        df = map_values(df, spec.region, rm, key, value, "region_code", key_fn=spec.region_key_fn)
    else:
        df = df.withColumn("region_code", F.lit(spec.country))
    df = df.withColumn("__year", F.col(spec.year).try_cast("int")).filter("__year is not null")
    agg = sum_counts(df.withColumn("__count", F.col(spec.count)),
                     ["region_code", "crime_category", "__year", *spec.group_extra],
                     count="__count", native=spec.native_category)
    if spec.retention in ("recent", "latest"):
        # the year is a group key, so cutting after the sum equals cutting
        # before it; the small aggregate is checkpointed so the max-year
        # subquery does not re-read and re-join the source rows
        from harmoniq.session import materialize
        agg = materialize(agg)
        agg = keep_recent(agg, "__year", spec.keep_years) if spec.retention == "recent" \
            else keep_latest(agg, "__year")
    agg = with_rate(attach_population(agg, regions))
    if as_of is None:
        retrieved = F.current_timestamp().cast("timestamp_ntz")
    else:
        retrieved = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp_ntz")
    country = F.lit(spec.country) if spec.country is not None else country_of("region_code")
    return canonicalise(
        agg,
        source_country=country, source_authority=spec.authority, source_url=spec.url,
        source_file_hash=file_hash, retrieved_at=retrieved,
        period_start=year_start("__year"), period_end=year_end("__year"), period_type="year",
        region_level=level_of("region_code"),
        suspect_dim=F.col("suspect_dim") if "suspect_dim" in agg.columns else F.lit("total"),
        denominator_source=F.when(F.col("denominator_population").isNotNull(), F.lit("region_dimension")),
    )


# X2 + A15: registry run with failure isolation ------------------------------------------
def run_sources(spark: SparkSession, sources: list[tuple[str, DataFrame, SourceSpec]], regions: DataFrame,
                table_path: str, as_of=None) -> DataFrame:
    """Run sources in order into the canonical table at ``table_path``
    (partitioned by ``source_country``).  Each source's rows are merged on
    the natural key with NULL == '' (last writer wins, so supplements listed
    last replace native totals), touching only the partitions it writes.
    Before the write every row is checked against the schema, the rules and
    the uniqueness of the natural key; a source with any violation is refused
    as a whole, and its record lists all of them.  A failing source is
    recorded and skipped; the others still run.
    Returns one run record per source: (source, status, n_rows,
    min_period, max_period, n_regions, error)."""
    from harmoniq.operators.quality import aggregate_rules, conform, refuse_invalid
    from harmoniq.operators.upsert import upsert_partitions
    from harmoniq.schema import AGGREGATE_KEY
    from harmoniq.session import materialize
    records = []
    try:                                    # an existing table is merged into, never replaced
        spark.read.parquet(table_path).schema
        exists = True
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "Unable to infer schema" not in str(e):
            raise
        exists = False
    for name, df, spec in sources:
        try:
            rows = materialize(conform(harmonise(spark, df, spec, regions, as_of=as_of), CRIME_AGGREGATES))
            refuse_invalid(rows, aggregate_rules(), list(AGGREGATE_KEY))
            stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min("period_start").alias("lo"),
                             F.max("period_end").alias("hi"), F.count_distinct("region_code").alias("r")).first()
            if not stats["n"]:              # a source without rows is a run with nothing to write
                pass
            elif not exists:
                rows.write.mode("errorifexists").partitionBy("source_country").parquet(table_path)
                exists = True
            else:
                upsert_partitions(spark, table_path, rows, list(AGGREGATE_KEY), ["source_country"],
                                  staging=f"{table_path.rstrip('/')}_staging")
            records.append((name, "ok", stats["n"], stats["lo"], stats["hi"], stats["r"], None))
        except Exception as e:  # noqa: BLE001  isolate one source's failure
            records.append((name, "failed", 0, None, None, 0, str(e)))
    schema = T.StructType([
        T.StructField("source", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("n_rows", T.LongType()), T.StructField("min_period", T.DateType()),
        T.StructField("max_period", T.DateType()), T.StructField("n_regions", T.LongType()),
        T.StructField("error", T.StringType())])
    return literal_table(spark, records, schema)
