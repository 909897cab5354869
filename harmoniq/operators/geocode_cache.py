"""The geocode cache as an append log.

Every batch of resolved keys is appended as an entry of its own (a snapshot
commit of one new partition); what was resolved last wins.  Compaction replaces
all entries by one.  Cache files written before the log (CSV, with or without a
region hint) can be taken in as its oldest entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.operators.snapshots import commit, pointers, read_snapshot

KEY = ["country", "city", "region_hint"]
FIELDS = T.StructType([T.StructField(c, T.StringType()) for c in KEY] + [
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()), T.StructField("nuts_code", T.StringType())])
LOG = T.StructType([*FIELDS.fields, T.StructField("entry", T.LongType())])


def _normal(rows: DataFrame) -> DataFrame:
    """Keys as they are looked up: upper country, lower and trimmed city and
    hint (a missing one is empty); empty coordinates and codes are NULL."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("")
    return rows.select(
        F.upper(text("country")).alias("country"), F.lower(F.trim(text("city"))).alias("city"),
        F.lower(F.trim(text("region_hint"))).alias("region_hint"),
        *[F.col(c).cast("string").try_cast("double").alias(c) for c in ("lat", "lon")],
        F.nullif(F.col("nuts_code"), F.lit("")).alias("nuts_code"))


def _one_per_key(rows: DataFrame, order: Column) -> DataFrame:
    best = rows.groupBy(*KEY).agg(F.max_by(F.struct("lat", "lon", "nuts_code"), order).alias("v"))
    return best.select(*KEY, "v.*")


def append_resolved(spark: SparkSession, root: str, rows: DataFrame) -> int:
    """Append resolved keys (a key that the geocoder did not find has NULLs:
    that is an answer, too).  A key that occurs twice in a batch keeps the row
    with coordinates, then the greater values.  Returns the entry's number."""
    before = (pointers(spark, root) or [0])[-1]
    once = _one_per_key(_normal(rows), F.struct("lat", "lon", "nuts_code"))
    return commit(spark, root, once.withColumn("entry", F.lit(before + 1).cast("bigint")), ["entry"], base=before)


def read_cache(spark: SparkSession, root: str) -> DataFrame:
    """The newest answer of every key."""
    return _one_per_key(read_snapshot(spark, root, LOG), F.col("entry"))


def compact(spark: SparkSession, root: str) -> int:
    """One entry in place of all; readers of the old ones are not disturbed."""
    before = (pointers(spark, root) or [0])[-1]
    rows = read_cache(spark, root).withColumn("entry", F.lit(before + 1).cast("bigint"))
    return commit(spark, root, rows, ["entry"], base=before, replace=True)
