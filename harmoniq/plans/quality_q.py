"""Data-quality bindings: Q1-Q5, A16, J15, U4, F3, F4."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.operators import quality as Q
from harmoniq.operators.dims import with_hierarchy
from harmoniq.plans import register
from harmoniq.plans.incidents_q import FINALIZED_SQL
from harmoniq.plans.common import SQL_FACTS, facts_table, nation_code, region_dim, table, with_ctes
from harmoniq.schema import AGGREGATE_KEY
from harmoniq.session import materialize, scratch_path

# fixed values: rule set for the orders demo (name, SQL predicate that flags a violation)
ORDER_RULES = [
    ("status_enum", "o_orderstatus NOT IN ('F', 'O')"),
    ("price_positive", "o_totalprice <= 0"),
    ("priority_format", "NOT regexp_like(o_orderpriority, '^[1-5]-[A-Z ]+$')"),
    ("date_range", "o_orderdate < TIMESTAMP '1995-01-01 00:00:00' OR o_orderdate > TIMESTAMP '2000-12-31 00:00:00'"),
    ("custkey_not_null", "o_custkey IS NULL"),
]
EVENT_TYPES_ALLOWED = ("click", "view", "purchase", "signup")
EVENT_RULES = [
    ("value_cap", "value > 400"),
    ("event_type_enum", "event_type NOT IN ('click', 'view', 'purchase', 'signup')"),
    ("props_shape", "left(props, 4) <> '{\"k\"'"),
]


def _rules(spec):
    return [(n, F.expr(p.replace("regexp_like", "rlike"))) for n, p in spec]


def _duck(p: str) -> str:
    return p.replace("regexp_like", "regexp_matches")


@register("quality_violations", oracle=" UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE COALESCE({_duck(p)}, false)) AS n_violations FROM orders"
    for n, p in ORDER_RULES))
def quality_violations(spark, sf_dir):
    return Q.rule_counts(table(spark, sf_dir, "orders"), _rules(ORDER_RULES))


@register("row_rules", oracle=" UNION ALL ".join(
    f"SELECT event_id, '{n}' AS rule FROM events WHERE COALESCE({_duck(p)}, false)"
    for n, p in EVENT_RULES))
def row_rules(spark, sf_dir):
    return Q.violations(table(spark, sf_dir, "events"), _rules(EVENT_RULES), ["event_id"])


@register("violation_samples", oracle="WITH v AS (" + " UNION ALL ".join(
    f"SELECT event_id, '{n}' AS rule FROM events WHERE COALESCE({_duck(p)}, false)"
    for n, p in EVENT_RULES) + """)
SELECT rule, COUNT(*) AS n_violations,
       list_sort(list(event_id ORDER BY event_id)[1:10]) AS sample
FROM v GROUP BY rule""")
def violation_samples(spark, sf_dir):
    return Q.violation_samples(table(spark, sf_dir, "events"), _rules(EVENT_RULES), "event_id", 10)


@register("canonical_rules", oracle=with_ctes(SQL_FACTS, " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE COALESCE({p}, false)) AS n_violations FROM facts"
    for n, p in Q.AGGREGATE_RULES_SQL)))
def canonical_rules(spark, sf_dir):
    """Q2 on the canonical fact table: every rule must count zero."""
    return Q.rule_counts(facts_table(spark, sf_dir), Q.aggregate_rules())


def planted_facts(spark, sf_dir):
    """The fact table and faulty copies of two categories' rows."""
    f = facts_table(spark, sf_dir)
    one = f.filter("crime_category = 'homicide'").withColumns({
        "count": -F.col("count"), "period_type": F.lit("week"), "region_level": F.lit(7)})
    two = f.filter("crime_category = 'robbery_violent'").withColumns({
        "source_country": F.lit("XYZ"), "source_url": F.lit(None).cast("string"), "crime_category": F.lit("theft"),
        "suspect_dim": F.lit("other"), "period_end": F.date_sub("period_start", 1)})
    again = f.filter("crime_category = 'sexual_assault'").withColumn("suspect_dim_value", F.lit(""))
    return f.unionByName(one).unionByName(two).unionByName(again)


SQL_PLANTED = f"""{SQL_FACTS},
planted AS (
  SELECT * FROM facts
  UNION ALL SELECT * REPLACE (-count AS count, 'week' AS period_type, 7 AS region_level)
  FROM facts WHERE crime_category = 'homicide'
  UNION ALL SELECT * REPLACE ('XYZ' AS source_country, NULL AS source_url, 'theft' AS crime_category,
                              'other' AS suspect_dim, CAST(period_start - INTERVAL 1 DAY AS DATE) AS period_end)
  FROM facts WHERE crime_category = 'robbery_violent'
  UNION ALL SELECT * REPLACE ('' AS suspect_dim_value) FROM facts WHERE crime_category = 'sexual_assault'
)"""


@register("canonical_rules_planted", oracle=with_ctes(SQL_PLANTED, " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE COALESCE({p}, false)) AS n_violations FROM planted"
    for n, p in Q.AGGREGATE_RULES_SQL)))
def canonical_rules_planted(spark, sf_dir):
    """Q2 on facts with planted faults: the broken rules fire."""
    return Q.rule_counts(planted_facts(spark, sf_dir), Q.aggregate_rules())


@register("dup_natural_keys", oracle=with_ctes(SQL_PLANTED, """
SELECT source_country, period_start, region_code, crime_category, suspect_dim,
       NULLIF(suspect_dim_value, '') AS suspect_dim_value, COUNT(*) AS n
FROM planted GROUP BY ALL HAVING COUNT(*) > 1"""))
def dup_natural_keys(spark, sf_dir):
    """Q3 on the natural key, where NULL and '' are one value."""
    return Q.duplicate_keys(planted_facts(spark, sf_dir), list(AGGREGATE_KEY), blank_is_null=True)


@register("dup_keys", oracle="""
WITH e AS (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_type = 'purchase')
SELECT event_id, COUNT(*) AS n FROM e GROUP BY event_id HAVING COUNT(*) > 1""")
def dup_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    doubled = e.unionByName(e.filter(F.col("event_type") == "purchase"))
    return Q.duplicate_keys(doubled, ["event_id"])


@register("domain_diff", oracle="""
SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')""")
def domain_diff(spark, sf_dir):
    return Q.domain_difference(table(spark, sf_dir, "events"), "event_type",
                               ("click", "view", "purchase"))


ORDERS_DECLARED = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType()),
])


@register("schema_check", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""")
def schema_check(spark, sf_dir):
    return Q.conform(table(spark, sf_dir, "orders"), ORDERS_DECLARED)


@register("schema_refusals", oracle="""
SELECT 'declared' AS given, false AS refused, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE o_totalprice IS NULL) AS n_null FROM orders
UNION ALL SELECT 'column missing', true, 0, 0 UNION ALL SELECT 'column more', true, 0, 0
UNION ALL SELECT 'junk values', false, COUNT(*), COUNT(*) FILTER (WHERE o_orderkey % 2 = 0) FROM orders""")
def schema_refusals(spark, sf_dir):
    """Q1: a missing or an additional column refuses the frame; values that are
    none of the declared type become NULL, which the non-null rules report."""
    o = table(spark, sf_dir, "orders")
    junk = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")))
    out = []
    for given, df in (("declared", o), ("column missing", o.drop("o_custkey")), ("column more", o.withColumn("x", F.lit(1))),
                      ("junk values", junk)):
        try:
            kept, refused = Q.conform(df, ORDERS_DECLARED), False
        except Q.SchemaMismatch:
            kept, refused = Q.conform(o.limit(0), ORDERS_DECLARED), True
        out.append(kept.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("o_totalprice").isNull(), 1)).alias("n_null"))
                   .select(F.lit(given).alias("given"), F.lit(refused).alias("refused"), "n_rows", "n_null"))
    rows = out[0]
    for x in out[1:]:
        rows = rows.unionByName(x)
    return rows


@register("missing_input", oracle="""
SELECT r_regionkey, r_name, true AS landed FROM region""")
def missing_input(spark, sf_dir):
    """An input that has not landed is a typed empty frame; together with
    the one that has it gives that one's rows."""
    from harmoniq.sources.files import read_or_empty
    r = table(spark, sf_dir, "region")
    path = scratch_path(spark, "landed")
    r.write.parquet(f"{path}/here")
    both = read_or_empty(spark, f"{path}/here", r.schema).withColumn("landed", F.lit(True))
    return both.unionByName(read_or_empty(spark, f"{path}/not_here", r.schema).withColumn("landed", F.lit(False)))


# ---- F3 / F4 / J15 -----------------------------------------------------------------------
def _customer_codes(spark, sf_dir):
    """Level-2 codes: nation code + first letter of the market segment."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.concat(nation_code("n_regionkey", "n_nationkey"),
                             F.substring("c_mktsegment", 1, 1)).alias("code")))


SQL_CUST_CODES = """
cc AS (
  SELECT 'R' || CAST(n.n_regionkey AS VARCHAR) || chr(65 + n.n_nationkey) || substr(c.c_mktsegment, 1, 1) AS code
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""


@register("hierarchy_codes", oracle=f"""WITH {SQL_CUST_CODES.strip()},
d AS (SELECT DISTINCT code FROM cc)
SELECT code, CAST(greatest(length(code) - 2, 0) AS INTEGER) AS level,
       CASE WHEN length(code) > 2 THEN left(code, length(code) - 1) END AS parent_code,
       left(code, 2) AS country,
       EXISTS (SELECT 1 FROM nation n WHERE 'R' || CAST(n.n_regionkey AS VARCHAR) || chr(65 + n.n_nationkey)
               = left(d.code, length(d.code) - 1)) AS parent_known
FROM d""")
def hierarchy_codes(spark, sf_dir):
    codes = with_hierarchy(_customer_codes(spark, sf_dir).distinct())
    known = region_dim(spark, sf_dir).select(F.col("code").alias("__k"), F.lit(True).alias("__f"))
    j = codes.join(known, codes.parent_code == known.__k, "left")
    return j.select("code", "level", "parent_code", "country",
                    F.coalesce("__f", F.lit(False)).alias("parent_known"))


@register("unknown_codes", oracle=f"""WITH {SQL_CUST_CODES.strip()},
allc AS (SELECT code FROM cc UNION ALL
         SELECT 'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) FROM nation)
SELECT DISTINCT code FROM allc
WHERE code NOT IN (SELECT 'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) FROM nation)
  AND code NOT IN (SELECT 'R' || CAST(r_regionkey AS VARCHAR) FROM region)""")
def unknown_codes(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(nation_code("n_regionkey", "n_nationkey").alias("code"))
    return Q.unknown_codes(_customer_codes(spark, sf_dir).unionByName(n), "code",
                           region_dim(spark, sf_dir))


# ---- Q5: the incident rules, and the write that they guard --------------------------------
def planted_incidents(spark, sf_dir, done=None):
    """Finished incidents (``done``, if they are stored already), some with faults."""
    from harmoniq.plans.incidents_q import finalized
    bad = F.pmod(F.ascii(F.substring("incident_id", 1, 1)) + F.ascii(F.substring("incident_id", 2, 1)), F.lit(7))
    done = finalized(spark, sf_dir) if done is None else done
    return done.withColumns({
        "confidence": F.when(bad == 1, "SURE").otherwise(F.col("confidence")),
        "lat": F.when(bad == 2, 95.0).otherwise(F.col("lat")),
        "victim_count": F.when(bad == 3, -1).otherwise(F.col("victim_count")).cast("bigint"),
        "review_status": F.when(bad == 4, F.lit(None)).otherwise(F.col("review_status")),
        "incident_id": F.when(bad == 5, F.concat(F.col("incident_id"), F.lit("x"))).otherwise(F.col("incident_id"))})


SQL_PLANTED_INCIDENTS = f"""
WITH f AS (SELECT *, (ascii(substr(incident_id, 1, 1)) + ascii(substr(incident_id, 2, 1))) % 7 AS bad FROM ({FINALIZED_SQL})),
planted AS (SELECT * REPLACE (
  CASE WHEN bad = 1 THEN 'SURE' ELSE confidence END AS confidence, CASE WHEN bad = 2 THEN 95.0 ELSE lat END AS lat,
  CASE WHEN bad = 3 THEN -1 ELSE victim_count END AS victim_count,
  CASE WHEN bad = 4 THEN NULL ELSE review_status END AS review_status,
  CASE WHEN bad = 5 THEN incident_id || 'x' ELSE incident_id END AS incident_id) FROM f)"""


@register("incident_rules", oracle=SQL_PLANTED_INCIDENTS + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE COALESCE({p.replace('regexp_like', 'regexp_matches')}, false)) "
    "AS n_violations FROM planted" for n, p in Q.INCIDENT_RULES_SQL))
def incident_rules(spark, sf_dir):
    """Q5 on finished incidents with planted faults."""
    return Q.rule_counts(planted_incidents(spark, sf_dir), Q.incident_rules())


@register("incident_table", oracle=f"""
WITH f AS ({FINALIZED_SQL})
SELECT incident_id, max(country) AS country, max(CASE WHEN country IN ('CL', 'VI') THEN 'reviewed' ELSE review_status END) AS review_status,
       CAST(1 AS BIGINT) AS refused FROM f GROUP BY incident_id""")
def incident_table(spark, sf_dir):
    """J7 + Q5: finished incidents are written; a batch with faults is refused
    whole; a later batch marks two countries' rows as reviewed."""
    from harmoniq.operators.registry import write_incidents
    from harmoniq.operators.snapshots import read_snapshot
    from harmoniq.plans.incidents_q import finalized
    root = scratch_path(spark, "incidents")
    done = materialize(finalized(spark, sf_dir))
    write_incidents(spark, root, done)
    refused = 0
    try:
        write_incidents(spark, root, planted_incidents(spark, sf_dir, done))
    except Q.InvalidRows:
        refused = 1
    write_incidents(spark, root, done.filter(F.col("country").isin("CL", "VI")).withColumn("review_status", F.lit("reviewed")))
    return read_snapshot(spark, root, done.schema).select("incident_id", "country", "review_status",
                                                          F.lit(refused).cast("bigint").alias("refused"))
