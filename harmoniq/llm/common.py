"""Shared helpers of the llm operators: folds, stored tables, Arrow text access."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harmoniq.session import scratch_path

# fixed value: ASCII white space of the word pattern [^\x20\x09-\x0D]+
ASCII_SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null ids: fold 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus, F.lit(0).cast("bigint"))


def is_held_out(id_col: str, modulus: int) -> Column:
    return fold(id_col, modulus) == 2


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared folder and read back: cuts the lineage and
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Input columns whose names the operator produces itself are replaced
    (Spark resolves names without regard to case)."""
    low = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def text_hash(col: str = "text") -> Column:
    """64-bit hash of the text; null and empty texts hash differently."""
    return F.when(F.col(col).isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.col(col)))


def numbered(df: DataFrame, name: str, group: str | None = None, order: list[str] | None = None,
             pos: str = "pos", total: str | None = None) -> DataFrame:
    """Stored rows with gapless ``pos`` from 0 (within ``group``, if any) and
    the group's number of rows in ``total``.  Rows are dealt out by ranges of
    (group, order), so a group that holds most rows lies over many partitions,
    and so do equal rows (the row's place before the shuffle ends every tie).
    Only row counts by partition and group are summed up."""
    keys = ([group] if group else []) + (order or [])
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    if keys:
        rows = rows.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie")
    rows = store(rows.drop("__tie").withColumn("__at", F.monotonically_increasing_id())
                 .withColumn("__part", F.shiftright("__at", 33)), name)
    by = [group] if group else []
    sizes = rows.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    # one row per partition and group: the windows hold counts, never rows
    of = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    sizes = sizes.withColumn("__before", F.sum("__n").over(of.orderBy("__part")) - F.col("__n"))
    if total:
        sizes = sizes.withColumn(total, F.sum("__n").over(of))
    out = rows.join(sizes.drop("__n"), by + ["__part"])
    return out.select(*df.columns, (F.col("__before") + F.col("__at") - F.col("__first")).alias(pos),
                      *([total] if total else []))


# ---- Arrow access -------------------------------------------------------------------
def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after the other, offsets of length n + 1); null
    texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = pc.fill_null(column, "") if column.null_count else column
    arr = arr.cast(pa.large_string())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def bounded(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int,
            max_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of at most ``max_bytes`` of text and ``max_rows``
    rows; a longer text is a run of its own, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
                         .astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + max_bytes, "right")))
            end = min(end, at + max_rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def as_bytes(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def by_group(df: DataFrame, key: list[str], order: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
             schema: str, rows: int = 20_000) -> DataFrame:
    """Hand whole key groups to ``fn`` in packs: hash partitions sorted by the
    key are cut only where the key changes, so thousands of small groups cost
    one call.  Callers bound the size of a group beforehand."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < rows:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cut = last_start(table, key)
            if cut:
                yield from fn(table.slice(0, cut))
            rest = table.slice(cut)
            held, n = rest.to_batches(), rest.num_rows
        if n:
            yield from fn(pa.Table.from_batches(held).combine_chunks())
    packed = df.repartition(*key).sortWithinPartitions(*key, *order)
    return packed.mapInArrow(run, schema)


def last_start(table: pa.Table, key: list[str]) -> int:
    """Row at which the last key group of a sorted table begins."""
    starts = group_starts(table, key)
    return int(starts[-1])


def group_starts(table: pa.Table, key: list[str]) -> np.ndarray:
    n = table.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for k in key:
        v = table.column(k).combine_chunks()
        v = v.to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def record_batch(schema_names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a)
                                       for a in arrays], names=schema_names)


# ---- words --------------------------------------------------------------------------
def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply, xor-shift), on uint64 arrays."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHasher:
    """64-bit hash per word with a bounded cache (words repeat a lot)."""

    def __init__(self, limit: int = 400_000):
        import xxhash
        self._digest, self._limit, self._seen = xxhash.xxh3_64_intdigest, limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self._seen) > self._limit:
            self._seen.clear()
        seen, digest = self._seen, self._digest
        for w in set(words).difference(seen):
            seen[w] = digest(w)
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
