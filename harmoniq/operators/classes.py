"""Connected classes of a link table (undirected), by alternating stars.

Each round rewires every node to the least neighbour it knows, so the number of
rounds grows with the logarithm of the longest path.  A round is two grouped
minima and two joins on the node; hot nodes are combined map-side in the minima
and split by Spark in the joins.  Nothing is collected but one fingerprint of
the link table per round, which tells whether it still changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmoniq.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_classes(links: DataFrame, a: str, b: str) -> DataFrame:
    """(member, class): every node of ``links`` with the least node it is
    connected to.  Links of a node with itself and null ends are ignored."""
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := _mark(edges)) != before:
        before = now
        edges = materialize(_small_star(_large_star(edges)))
    # every edge now leads from a member to its class
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.union(roots).select(F.col("u").alias("member"), F.col("v").alias("class"))
