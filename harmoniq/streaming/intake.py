"""Structured Streaming forms of the incremental intake.

* T1 overlapping pulls deduplicated by key inside an event-time watermark
  (state is bounded by the watermark, not by history);
* T1 with accounts: rows behind the watermark go to an output of their own
  instead of vanishing, so kept + late + duplicates = input;
* T2 idempotent upsert per micro-batch through ``foreachBatch``: each batch
  merges into the newest complete version and writes the next free one; the
  merge is newer-wins, so a retried batch changes nothing;
* T4 unchanged files skipped by content hash against a manifest.

Checkpoints and outputs live under the shared ``spark.checkpoint.dir``, so
a restarted driver (or lost executors) resume from the last commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.operators.upsert import null_safe_key


def dedupe_stream(stream: DataFrame, keys: list[str], event_time: str,
                  delay: str = "40 days") -> DataFrame:
    """First arrival per key within the watermark.  The event time must
    be a TIMESTAMP (NTZ columns are cast)."""
    s = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return s.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run_available(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                  output_mode: str = "append") -> None:
    """Process everything available now, then stop (batch-like scheduling,
    streaming bookkeeping)."""
    q = (df.writeStream.format(fmt).outputMode(output_mode).option("path", sink_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def newer_wins(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Order-independent merge: per key the row with the greatest ``order``
    survives, whichever batch it arrived in (grouped max_by, map-side
    combined)."""
    cols = existing.columns
    both = existing.unionByName(incoming.select(*cols))
    g = both.groupBy(*[null_safe_key(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("__row"))
    return g.select("__row.*")


def upsert_batches(spark: SparkSession, stream: DataFrame, table_root: str, checkpoint: str,
                   keys: list[str], order: list[str], partition_by: list[str] | None = None) -> None:
    """Each micro-batch merges into the table at ``table_root``.

    Without ``partition_by`` the merged table is written as the version after
    the newest one (small tables), whichever checkpoint the batch comes from;
    a version whose write was cut off is never read.  With ``partition_by``
    (large tables; the partition columns must be functions of the key) only
    the partitions the batch touches are merged and rewritten in place; the
    merge is idempotent, so a retried batch changes nothing."""
    if partition_by:
        from harmoniq.operators.upsert import fresh_stage, write_partitions

        def merge_scoped(batch: DataFrame, batch_id: int) -> None:
            cols = batch.columns
            # newer row per key inside the batch, then newer-wins against the table
            b = newer_wins(batch.limit(0), batch, keys, order)
            try:
                existing = spark.read.parquet(table_root)
            except Exception as e:  # noqa: BLE001  first batch creates the table
                if "PATH_NOT_FOUND" not in str(e) and "Unable to infer schema" not in str(e):
                    raise
                b.write.partitionBy(*partition_by).parquet(table_root)
                return
            touched = b.select(*partition_by).distinct()
            scoped = existing.join(touched, partition_by, "left_semi").select(*cols)
            merged = newer_wins(scoped, b, keys, order)
            stage = fresh_stage(f"{table_root.rstrip('/')}_staging")
            merged.write.mode("errorifexists").partitionBy(*partition_by).parquet(stage)
            write_partitions(spark.read.parquet(stage).select(*cols), table_root, partition_by)

        q = (stream.writeStream.foreachBatch(merge_scoped).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return

    from harmoniq.operators.upsert import newest_version

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest = newest_version(spark, table_root)
        merged = batch if latest is None else newer_wins(
            spark.read.parquet(f"{table_root}/version={latest}"), batch, keys, order)
        free = (newest_version(spark, table_root, complete=False) or 0) + 1
        merged.write.mode("errorifexists").parquet(f"{table_root}/version={free}")

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def snapshot_batches(spark: SparkSession, stream: DataFrame, table_root: str, checkpoint: str, keys: list[str],
                     order: list[str], partition_by: list[str]) -> None:
    """T2 for large tables: each micro-batch is one snapshot commit of the
    partitions that it touches (``operators.snapshots``); readers meet the table
    before or after a batch.  Newer rows win, so a retried batch changes nothing.
    The partition columns must be functions of the key."""
    from harmoniq.operators.snapshots import upsert_snapshot

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            upsert_snapshot(spark, table_root, batch, keys, partition_by, stream.schema, order=order, newer_wins=True)

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# ---- T1 with an output for late rows -----------------------------------------------------
def _folder(root: str, name: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{name}/batch={batch_id}"


def _earlier(spark: SparkSession, root: str, name: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """Rows of the batches before this one (a retried batch does not see its own)."""
    wide = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(wide).parquet(f"{root.rstrip('/')}/{name}").filter(F.col("batch") < batch_id)
    except Exception as e:  # noqa: BLE001  nothing has been written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], wide)


CLOCK = T.StructType([T.StructField("newest", T.TimestampNTZType()), T.StructField("rows_in", T.LongType()),
                      T.StructField("late", T.LongType()), T.StructField("kept", T.LongType()),
                      T.StructField("duplicates", T.LongType())])


def dedupe_with_late(spark: SparkSession, stream: DataFrame, root: str, checkpoint: str, keys: list[str],
                     event_time: str, tie: str, delay_days: int) -> None:
    """First arrival per key, with every row accounted for.

    The watermark of a batch is the newest event time of the batches before it
    less ``delay_days``.  A row behind it goes to ``root/late``.  Of the others, a
    row is a duplicate if its batch has an earlier one with its key (by event
    time, then ``tie``) or a batch before kept one whose event time is not
    ``delay_days`` behind the watermark; the rest goes to ``root/kept``, in folders
    by day, of which only those inside that span are read again.  ``root/clock``
    has one row per batch: newest event time and row counts.  Rows without an
    event time are late.

    Each batch writes folders named by its id, so a batch that is run again
    after a failure replaces what it had written."""
    day = F.to_date(event_time)
    schema = stream.schema
    kept_schema = T.StructType([*schema.fields, T.StructField("day", T.DateType())])

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                          # read by both outputs and the counts
        try:
            divide(batch, batch_id)
        finally:
            batch.unpersist()

    def divide(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import Observation

        from harmoniq.operators.steps import observed
        newest = _earlier(spark, root, "clock", CLOCK, batch_id).agg(F.max("newest")).first()[0]
        span = F.expr(f"interval {int(delay_days)} days")
        mark = F.lit(newest).cast("timestamp_ntz") - span
        behind = F.lit(False) if newest is None else F.col(event_time) < mark
        late = F.coalesce(behind, F.lit(True)) | F.col(event_time).isNull()
        seen = Observation()
        rows = batch.withColumn("__late", late)
        rows.filter("__late").drop("__late").observe(seen, F.count(F.lit(1)).alias("late")).write.mode("overwrite").parquet(
            _folder(root, "late", batch_id))
        first = rows.filter("not __late").groupBy(*[null_safe_key(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
            F.min_by(F.struct(*schema.names), F.struct(event_time, tie)).alias("row"), F.count(F.lit(1)).alias("__n"))
        before = _earlier(spark, root, "kept", kept_schema, batch_id)
        if newest is not None:
            before = before.filter((F.col("day") >= F.to_date(mark - span)) & (F.col(event_time) >= mark - span))
        held = before.select(*[null_safe_key(k).alias(f"__h{i}") for i, k in enumerate(keys)])
        same = [F.col(f"__k{i}") == F.col(f"__h{i}") for i in range(len(keys))]
        fresh = first.join(held, same, "left_anti").select("row.*").withColumn("day", day)
        count = Observation()
        fresh.observe(count, F.count(F.lit(1)).alias("kept")).write.mode("overwrite").partitionBy("day").parquet(
            _folder(root, "kept", batch_id))
        n = batch.agg(F.count(F.lit(1)).alias("n"), F.max(event_time).alias("newest")).first()
        tops = [t for t in (newest, n["newest"]) if t is not None]
        n_late, n_kept = observed(seen).get("late") or 0, observed(count).get("kept") or 0
        spark.createDataFrame([(max(tops, default=None), n["n"], n_late, n_kept, n["n"] - n_late - n_kept)], CLOCK) \
            .coalesce(1).write.mode("overwrite").parquet(_folder(root, "clock", batch_id))

    q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType(), False), T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False), T.StructField("content", T.BinaryType(), True),
])
MANIFEST = T.StructType([T.StructField("path", T.StringType()), T.StructField("sha256", T.StringType())])


PREFIX = 2                 # hex digits of the hash that name a manifest partition


def manifest_lookup(spark: SparkSession, manifest_root: str, hashed: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """Rows of ``hashed`` (path, sha256) whose content is not in the manifest.
    Only the partitions that the batch's hashes fall into are read: their
    names, at most ``16 ** prefix``, are a literal filter on the partition column."""
    names = [r[0] for r in hashed.select(F.left("sha256", F.lit(prefix)).alias("p")).distinct().collect()]
    wide = T.StructType([*MANIFEST.fields, T.StructField("prefix", T.StringType())])
    try:
        seen = spark.read.schema(wide).parquet(manifest_root)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return hashed
    seen = seen.filter(F.col("prefix").isin(*names)).select("sha256")
    return hashed.join(seen, "sha256", "left_anti")


def manifest_batches(spark: SparkSession, stream: DataFrame, manifest_root: str, checkpoint: str,
                     prefix: int = PREFIX) -> None:
    """T4: append (path, sha256) of files whose content hash is new; a file
    whose bytes were already seen is a no-op.  A batch's files are hashed once;
    the manifest is partitioned by the first digits of the hash."""
    from harmoniq.session import materialize

    def step(batch: DataFrame, batch_id: int) -> None:
        hashed = materialize(batch.select("path", F.sha2("content", 256).alias("sha256")))
        fresh = manifest_lookup(spark, manifest_root, hashed, prefix)
        (fresh.groupBy("sha256").agg(F.min("path").alias("path"))
         .select("path", "sha256", F.left("sha256", F.lit(prefix)).alias("prefix"))
         .repartition("prefix").write.mode("append").partitionBy("prefix").parquet(manifest_root))

    q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def article_stream_dedupe(stream: DataFrame, url: str = "url", published: str = "published_at",
                          fallback_time=None, delay: str = "40 days") -> DataFrame:
    """T1 for article intake: overlapping monthly pulls land the same URL
    again; the first arrival per trimmed URL inside the watermark is kept.
    Records without a parseable ``published_at`` take ``fallback_time``
    (default: processing time) as their event time; URL-less records are
    dropped (P22)."""
    fb = fallback_time if fallback_time is not None else F.current_timestamp()
    ev = F.coalesce(F.try_to_timestamp(F.col(published)), fb).cast("timestamp")
    s = (stream.filter(F.trim(F.coalesce(F.col(url), F.lit(""))) != "")
         .withColumn("__url", F.trim(F.col(url))).withColumn("__event_time", ev))
    return s.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark(["__url"]).drop("__url")
