"""Data-quality operators: schema conformance, rule engine, duplicate keys,
referential and domain checks.

Rules are evaluated in one pass: every row yields the array of rule names
it breaks; counts come from one aggregate, samples from a salted two-phase
top-n (never a collect of all violations, never one task per rule).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.schema import CRIME_CATEGORIES, PERIOD_TYPES, SUSPECT_DIMS


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Q1: exact column set (raise on extra/missing when strict), columns in
    declared order, values coerced to declared types (``try_cast``: junk
    becomes NULL, which the non-null rules then report)."""
    have, want = set(df.columns), [f.name for f in schema.fields]
    missing, extra = [c for c in want if c not in have], sorted(have - set(want))
    if strict and (missing or extra):
        raise SchemaMismatch(f"missing={missing} extra={extra}")
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def _sql_list(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


# Q2 rules of crime_aggregates: (name, SQL predicate true when violated)
AGGREGATE_RULES_SQL = [
    ("source_country_len", "length(source_country) <> 2"),
    ("period_type_enum", f"period_type NOT IN ({_sql_list(PERIOD_TYPES)})"),
    ("region_level_range", "NOT (region_level BETWEEN 0 AND 3)"),
    ("crime_category_enum", f"crime_category NOT IN ({_sql_list(CRIME_CATEGORIES)})"),
    ("suspect_dim_enum", f"suspect_dim NOT IN ({_sql_list(SUSPECT_DIMS)})"),
    ("count_non_negative", "count < 0"),
    ("period_order", "period_end < period_start"),
] + [(f"{c}_not_null", f"{c} IS NULL") for c in (
    "source_country", "source_authority", "source_url", "source_file_hash", "retrieved_at", "period_start",
    "period_end", "period_type", "region_code", "region_level", "crime_category", "crime_category_native",
    "suspect_dim", "count")]


# Q5 rules of the incidents table
INCIDENT_RULES_SQL = [
    ("incident_id_not_null", "incident_id IS NULL"),
    ("incident_id_format", "NOT regexp_like(incident_id, '^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$')"),
    ("confidence_enum", "confidence NOT IN ('HIGH', 'MEDIUM', 'LOW')"),
    ("location_precision_enum", "location_precision NOT IN ('exact', 'city', 'region')"),
    ("lat_range", "lat < -90 OR lat > 90"),
    ("lon_range", "lon < -180 OR lon > 180"),
    ("victim_count_non_negative", "victim_count < 0"),
    ("review_status_not_null", "review_status IS NULL"),
]


def incident_rules() -> list[tuple[str, Column]]:
    return [(n, F.expr(p.replace("regexp_like", "rlike"))) for n, p in INCIDENT_RULES_SQL]


def aggregate_rules() -> list[tuple[str, Column]]:
    """Q2 rules of crime_aggregates as (name, violated-when) Columns."""
    return [(n, F.expr(p)) for n, p in AGGREGATE_RULES_SQL]


def broken_rules(rules: list[tuple[str, Column]]) -> Column:
    """Array of the names of rules a row breaks (a NULL test counts as not
    broken; non-null rules cover NULLs explicitly)."""
    flags = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def rule_counts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """One-pass violation counts: one row per rule (rule, n_violations)."""
    aggs = [F.sum(F.coalesce(cond, F.lit(False)).cast("int")).cast("bigint").alias(name)
            for name, cond in rules]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).alias("n_violations"))
        for n, _ in rules])).alias("r")).select("r.*")


def violations(df: DataFrame, rules: list[tuple[str, Column]], key: list[str]) -> DataFrame:
    """Q4/Q5: one row per (row, broken rule) with the row's key."""
    return (df.select(*key, F.explode(broken_rules(rules)).alias("rule")))


def violation_samples(df: DataFrame, rules, key: str, n: int = 10, salt_buckets: int = 64) -> DataFrame:
    """Per rule: count and the first ``n`` offending keys (ascending).

    Counts are a partial aggregate.  Samples are a two-phase top-n: first
    the n smallest keys per (rule, hash bucket of the key), then the n
    smallest of those <= n x buckets survivors per rule, so a rule broken
    by a third of all rows is never sorted inside one task."""
    from pyspark.sql import Window
    v = violations(df, rules, [key]).distinct()
    counts = violations(df, rules, [key]).groupBy("rule").agg(F.count(F.lit(1)).alias("n_violations"))
    salted = v.withColumn("__b", F.abs(F.xxhash64(key)) % salt_buckets)
    w1 = Window.partitionBy("rule", "__b").orderBy(key)
    first = salted.withColumn("__rn", F.row_number().over(w1)).filter(F.col("__rn") <= n)
    w2 = Window.partitionBy("rule").orderBy(key)
    top = first.drop("__rn").withColumn("__rn", F.row_number().over(w2)).filter(F.col("__rn") <= n)
    samples = top.groupBy("rule").agg(F.array_sort(F.collect_list(key)).alias("sample"))
    return counts.join(samples, "rule", "left")


def duplicate_keys(df: DataFrame, keys: list[str], blank_is_null: bool = False) -> DataFrame:
    """Keys occurring more than once (NULL groups with NULL, and
    with '' when ``blank_is_null``, as the natural key has it)."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    by = [F.nullif(F.col(k), F.lit("")).alias(k) if blank_is_null and k in text else F.col(k) for k in keys]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


class InvalidRows(ValueError):
    pass


def refuse_invalid(df: DataFrame, rules: list[tuple[str, Column]], keys: list[str]) -> None:
    """Q1-Q3 before a write: count every broken rule and every repeated key
    over all rows; raise with all of them.  One row per rule reaches the driver."""
    broken = [f"{r['rule']}: {r['n_violations']} rows"
              for r in rule_counts(df, rules).filter("n_violations > 0").orderBy("rule").collect()]
    repeated = duplicate_keys(df, keys, blank_is_null=True).count()
    if repeated:
        broken.append(f"repeated keys: {repeated}")
    if broken:
        raise InvalidRows("; ".join(broken))


def unknown_codes(df: DataFrame, code: str, dim: DataFrame, dim_code: str = "code") -> DataFrame:
    """Distinct codes absent from the dimension."""
    codes = df.select(F.col(code).alias("code")).distinct()
    return codes.join(dim.select(F.col(dim_code).alias("code")), "code", "left_anti")


def domain_difference(df: DataFrame, col: str, allowed) -> DataFrame:
    """U4: distinct values outside an allowed set."""
    return df.select(col).distinct().filter(~F.col(col).isin(*allowed))
