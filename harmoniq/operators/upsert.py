"""Upserts on a natural key and versioned, partition-aware writes.

The merge is ``existing LEFT ANTI incoming-keys UNION ALL incoming``:
two shuffles at most (or one broadcast when AQE measures the incoming batch
as small), no row-by-row MERGE.  NULL and '' are the same key value; both
sides coalesce key parts to strings so the join stays an equi-join (an OR
of IS NULL tests would degrade it to a nested loop).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def collapse_batch(incoming: DataFrame, keys: list[str], order) -> DataFrame:
    """Reject duplicate keys inside one incoming batch: the row with the
    greatest ``order`` (a column name or a list of them, compared in turn)
    wins (grouped max_by, partial-aggregated)."""
    if order is None:
        return incoming
    cols = incoming.columns
    by = F.struct(*[F.col(c) for c in ([order] if isinstance(order, str) else order)])
    nk = [null_safe_key(k).alias(f"__nk{i}") for i, k in enumerate(keys)]
    g = incoming.groupBy(*nk).agg(F.max_by(F.struct(*cols), by).alias("__row"))
    return g.select("__row.*")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str],
           order=None) -> DataFrame:
    """Last writer wins on ``keys`` (NULL == '')."""
    inc = collapse_batch(incoming, keys, order)
    inc_keys = inc.select(*[null_safe_key(k).alias(f"__ik{i}") for i, k in enumerate(keys)])
    cond = reduce(lambda a, b: a & b,
                  [null_safe_key(k) == F.col(f"__ik{i}") for i, k in enumerate(keys)])
    kept = existing.join(inc_keys, cond, "left_anti")
    return kept.unionByName(inc.select(*existing.columns))


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """By-name concatenation of per-file or per-source frames."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


# S2 -------------------------------------------------------------------------------
def write_version(df: DataFrame, root: str, version: int, compression: str = "zstd") -> str:
    """Write a whole-table rewrite as a new version directory
    (``root/version=N``) instead of overwriting the path being read; readers
    pick the version they want with partition pruning."""
    path = f"{root.rstrip('/')}/version={int(version)}"
    df.write.mode("errorifexists").option("compression", compression).parquet(path)
    return path


def read_version(spark, root: str, version: int | None = None) -> DataFrame:
    """Read one version (default: the newest) of a versioned table."""
    if version is None:
        version = newest_version(spark, root)
        if version is None:
            raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/version={int(version)}")


def newest_version(spark, root: str, complete: bool = True) -> int | None:
    """Highest ``version=N`` folder under ``root`` by listing it (no scan).
    A write that was cut off leaves a folder without its success mark; it
    counts only with ``complete=False`` (to choose a free number)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    found = sorted((int(n[8:]) for n in names if n.startswith("version=") and n[8:].isdigit()), reverse=True)
    mark = lambda n: spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/version={n}/_SUCCESS")
    return next((n for n in found if not complete or fs.exists(mark(n))), None)


def write_partitions(df: DataFrame, path: str, partition_by: list[str],
                     compression: str = "zstd") -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition
    overwrite): a country re-run rewrites that country's folder only."""
    (df.write.mode("overwrite").option("compression", compression)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def fresh_stage(base: str) -> str:
    """A staging folder that no earlier call has written to."""
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def upsert_partitions(spark, path: str, incoming: DataFrame, keys: list[str], partition_by: list[str],
                      order: str | None = None, staging: str | None = None) -> DataFrame:
    """J6 scoped to the partitions the batch touches: only partitions whose
    values occur in ``incoming`` are read (a semi-join on the partition
    columns, pruned at runtime by dynamic partition pruning), merged, and
    rewritten with dynamic partition overwrite; every other partition of a
    large table is left untouched.  The merged partitions are staged first,
    in a folder of their own per call under ``staging`` (default ``path +
    '_staging'``), so the overwrite neither reads the files it replaces nor
    sees what an earlier call staged."""
    existing = spark.read.parquet(path)
    touched = incoming.select(*partition_by).distinct()
    scoped = existing.join(touched, partition_by, "left_semi")
    merged = upsert(scoped, incoming.select(*existing.columns), keys, order)
    stage = fresh_stage(staging or path.rstrip("/") + "_staging")
    merged.write.mode("errorifexists").partitionBy(*partition_by).parquet(stage)
    write_partitions(spark.read.schema(existing.schema).parquet(stage).select(*existing.columns), path, partition_by)
    return spark.read.parquet(path)
