"""Upsert bindings: J6 (natural key, NULL == ''), J7 (single key), U1, S2/S1."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmoniq.operators.upsert import read_version, upsert, write_version
from harmoniq.plans import register
from harmoniq.plans.common import table
from harmoniq.session import scratch_path

NEW_KEY_OFFSET = 1_000_000_000


def _orders_base(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit(None).cast("string").alias("note"), "o_totalprice", "o_orderstatus")


def _orders_changes(spark, sf_dir):
    """Changed slice: pending orders re-priced (key note '' == existing
    NULL, so they replace), plus the same orders under new keys."""
    p = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    changed = p.select("o_orderkey", F.lit("").alias("note"),
                       (F.col("o_totalprice") + 1.0).alias("o_totalprice"), "o_orderstatus")
    fresh = p.select((F.col("o_orderkey") + NEW_KEY_OFFSET).alias("o_orderkey"),
                     F.lit(None).cast("string").alias("note"), "o_totalprice", "o_orderstatus")
    return changed.unionByName(fresh)


@register("upsert_natural_key", oracle=f"""
WITH e AS (SELECT o_orderkey, CAST(NULL AS VARCHAR) AS note, o_totalprice, o_orderstatus FROM orders),
n AS (
  SELECT o_orderkey, '' AS note, o_totalprice + 1.0 AS o_totalprice, o_orderstatus
  FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey + {NEW_KEY_OFFSET}, CAST(NULL AS VARCHAR), o_totalprice, o_orderstatus
  FROM orders WHERE o_orderstatus = 'P'
)
SELECT * FROM e WHERE NOT EXISTS (
  SELECT 1 FROM n WHERE n.o_orderkey = e.o_orderkey AND COALESCE(n.note, '') = COALESCE(e.note, ''))
UNION ALL SELECT * FROM n""", headline=True)
def upsert_natural_key(spark, sf_dir):
    """Merged table written as a new version directory and read back."""
    merged = upsert(_orders_base(spark, sf_dir), _orders_changes(spark, sf_dir),
                    ["o_orderkey", "note"])
    root = scratch_path(spark, "orders_versions")
    write_version(merged, root, 1)
    return read_version(spark, root)


@register("upsert_single_key", oracle="""
WITH n0 AS (
  SELECT c_custkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, 1 AS seq
  FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL
  SELECT c_custkey, c_acctbal + 2, c_mktsegment, 2 FROM customer WHERE c_mktsegment = 'MACHINERY'
),
n AS (SELECT c_custkey, arg_max(c_acctbal, seq) AS c_acctbal, arg_max(c_mktsegment, seq) AS c_mktsegment
      FROM n0 GROUP BY c_custkey)
SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM n)
UNION ALL SELECT * FROM n""")
def upsert_single_key(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    m = c.filter(F.col("c_mktsegment") == "MACHINERY")
    batch = (m.select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment",
                      F.lit(1).alias("seq"))
             .unionByName(m.select("c_custkey", (F.col("c_acctbal") + 2).alias("c_acctbal"),
                                   "c_mktsegment", F.lit(2).alias("seq"))))
    return upsert(c, batch, ["c_custkey"], order="seq")
