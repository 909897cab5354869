"""Rendezvous hashing of stable record keys over weighted shards (native).

Each record key is scored against every shard and goes to the best score; a
shard of weight w wins a share proportional to w.  Adding a shard changes only
the records that the new shard wins.

Results: a null key is hashed as the text 'null-key' (all null keys share a shard);
equal scores go to the lower shard; repeated rows get the same shard and
distinct slots; an empty table gives an empty table; input columns named like
a produced column are replaced.  Texts are only measured, so their length
does not matter; a null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_BUCKETS = 1024


def shard_score(key: Column, shard: int, weight: float, seed: int) -> Column:
    """-ln(u) / w with u uniform in (0, 1) from the key and the shard: an
    exponential race that shard wins with probability w / sum(w)."""
    h = F.xxhash64(key, F.lit(shard), F.lit(seed))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
    return -F.ln(u) / F.lit(float(weight))


def best_shard(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Shard with the least race time; shards of weight 0 take no records."""
    race = [F.struct(shard_score(key, i, w, seed).alias("t"), F.lit(i).alias("i"))
            for i, w in enumerate(weights) if w > 0]
    if not race:
        raise ValueError("at least one shard needs a positive weight")
    return (F.least(*race) if len(race) > 1 else race[0])["i"]


def record_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit("null-key"))


def assign_shards(df: DataFrame, weights: Sequence[float], id_col: str = "doc_id", seed: int = 0,
                  grown_weight: float = 1.0) -> DataFrame:
    """Append ``shard`` and ``grown_shard`` (the shard with one more shard of
    ``grown_weight``) to the rows; no shuffle.  Both races run in one
    expression: the grown shard is the newcomer where it beats the winner."""
    from harmoniq.llm.common import without
    key = record_key(id_col)
    race = [F.struct(shard_score(key, i, w, seed).alias("t"), F.lit(i).alias("i"))
            for i, w in enumerate(weights) if w > 0]
    if not race:
        raise ValueError("at least one shard needs a positive weight")
    best = F.least(*race) if len(race) > 1 else race[0]
    out = without(df, "shard", "grown_shard", "__best")
    out = out.withColumn("__best", best)
    newcomer = shard_score(key, len(weights), grown_weight, seed)
    return (out.withColumn("shard", F.col("__best.i").cast("int"))
            .withColumn("grown_shard", F.when(newcomer < F.col("__best.t"), F.lit(len(weights)))
                        .otherwise(F.col("__best.i")).cast("int"))
            .drop("__best"))


def with_slots(df: DataFrame, order: Sequence[str], buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Gapless ``slot`` numbers from 0 within each shard.  A shard is never
    one task: different rows are numbered inside (shard, hash bucket) groups and
    each bucket starts where the earlier ones end.  Equal rows are counted first
    and get their run of slots from the count, so a row that makes up a third of
    the table is one row here.  Pass narrow rows of types that can be grouped."""
    from harmoniq.llm.common import without
    rows = without(df, "slot", "__b", "__start", "__i", "__n", "__k")
    names = [f"`{c}`" for c in rows.columns]
    rest = [c for c in rows.columns if c not in order]
    b = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__b", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))
    sizes = b.groupBy("shard", "__b").agg(F.sum("__n").alias("__n"))
    upto = Window.partitionBy("shard").orderBy("__b")
    starts = sizes.select("shard", "__b", (F.sum("__n").over(upto) - F.col("__n")).alias("__start"))
    before = Window.partitionBy("shard", "__b").orderBy(*order, *[f"`{c}`" for c in rest])
    numbered = b.withColumn("__i", F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n"))
    out = numbered.join(starts, ["shard", "__b"]).withColumn(
        "__k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)))
    return out.select(*names, (F.col("__start") + F.col("__i") + F.col("__k")).cast("bigint").alias("slot"))
