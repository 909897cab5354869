"""A partitioned table whose readers never meet a half-done write.

Plain Parquet folders and one small file per commit:

    root/commit=<n>-<id>/<partition folders>/part-*.parquet
    root/_pointers/<n>                one partition folder per line

A commit writes the partitions that it touches into a folder of its own and then
a pointer that names, for every partition of the table, the folder that holds
it now.  The pointer appears by one rename: before it readers see the table as
it was, after it as it is; a write that is cut off leaves a folder that no
pointer names.  Nothing is ever overwritten, so a reader that has resolved a
pointer keeps its files.  Of two writers that start from the same pointer one
fails (``Conflict``) and may try again.

A commit reads only the partitions that the batch touches.  The pointer has a
line per partition, which bounds what the driver holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.operators.upsert import collapse_batch, null_safe_key

POINTERS = "_pointers"


class Conflict(RuntimeError):
    pass


class _Folder:
    """A folder of any file system that Spark can reach, through the driver's JVM."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        root = self._path(self.path)
        self.fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def names(self, sub: str = "") -> list[str]:
        folder = self._path(f"{self.path}/{sub}" if sub else self.path)
        return [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write beside, then rename; False if the name is taken."""
        final, beside = self._path(f"{self.path}/{name}"), self._path(f"{self.path}/{name}.{uuid.uuid4().hex}.new")
        stream = self.fs.create(beside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        # not every file system refuses to rename onto a file
        return not self.fs.exists(final) and bool(self.fs.rename(beside, final))


def pointers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in _Folder(spark, root).names(POINTERS) if n.isdigit())


def _partitions(spark: SparkSession, root: str, number: int | None) -> dict[str, str]:
    """{partition folder's name: commit that holds it} of a pointer (default: the newest)."""
    if number is None:
        found = pointers(spark, root)
        if not found:
            return {}
        number = found[-1]
    lines = _Folder(spark, root).read(f"{POINTERS}/{number}").splitlines()
    return {place.partition("/")[2]: place.partition("/")[0] for place in lines}


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """The table as the newest (or a given) pointer has it; filters on the
    partition columns prune its folders."""
    held = _partitions(spark, root, number)
    if not held:
        return spark.createDataFrame([], schema)
    root = root.rstrip("/")
    paths = [f"{root}/{commit}/{part}" if part else f"{root}/{commit}" for part, commit in held.items()]
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())]))
    return found.option("basePath", root).parquet(*paths).select(*[f.name for f in schema.fields])


def _leaves(folder: _Folder, commit: str, depth: int) -> list[str]:
    level = [""]
    for _ in range(depth):
        level = [f"{up}/{n}".lstrip("/") for up in level for n in folder.names(f"{commit}/{up}".rstrip("/")) if "=" in n]
    return level


def commit(spark: SparkSession, root: str, rows: DataFrame, partition_by: list[str],
           check: Callable[[], None] | None = None, base: int | None = None, replace: bool = False) -> int:
    """Write ``rows`` as the new content of the partitions that they lie in
    (with ``replace``: of the whole table).
    ``check`` runs after the write and before the pointer: if it raises, the
    table stays as it was.  ``base`` is the pointer that the rows were made
    from (default: the newest now)."""
    folder = _Folder(spark, root)
    before = base if base is not None else (pointers(spark, root) or [0])[-1]
    held = _partitions(spark, root, before) if before else {}
    name = f"commit={before + 1:08d}-{uuid.uuid4().hex[:12]}"
    (rows.write.mode("errorifexists").option("compression", "zstd").partitionBy(*partition_by)
     .parquet(f"{root.rstrip('/')}/{name}"))
    if check is not None:
        check()
    held = {} if replace else held
    held |= dict.fromkeys(_leaves(folder, name, len(partition_by)), name)
    folder.fs.mkdirs(folder._path(f"{folder.path}/{POINTERS}"))
    text = "".join(f"{c}/{p}\n" for p, c in sorted(held.items()))
    if not folder.put(f"{POINTERS}/{before + 1}", text):
        raise Conflict(f"{root}: another commit followed pointer {before}")
    return before + 1


def upsert_snapshot(spark: SparkSession, root: str, incoming: DataFrame, keys: list[str], partition_by: list[str],
                    schema: T.StructType, order=None, newer_wins: bool = False,
                    observe: Callable[[DataFrame], DataFrame] = lambda df: df,
                    check: Callable[[], None] | None = None, carried: tuple = ()) -> int:
    """Last writer wins on ``keys`` (NULL == ''), or with ``newer_wins`` the
    row with the greatest ``order``, whichever batch it came in.  Only touched
    partitions are read and rewritten.  ``observe`` may wrap the incoming rows
    where they enter the write, and drops the ``carried`` columns there."""
    before = (pointers(spark, root) or [0])[-1]
    cols = [f.name for f in schema.fields]
    batch = collapse_batch(incoming.select(*cols, *carried), keys, order)
    if not before:
        return commit(spark, root, observe(batch), partition_by, check, before)
    touched = batch.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(partition_by)]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(partition_by)]
    scope = read_snapshot(spark, root, schema, before)
    scope = scope.join(touched, same, "left_semi")
    if newer_wins:
        by = order if isinstance(order, list) else [order]
        both = scope.unionByName(observe(batch))
        merged = both.groupBy(*[null_safe_key(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
            F.max_by(F.struct(*cols), F.struct(*by)).alias("row")).select("row.*")
    else:
        new = batch.select(*[null_safe_key(k).alias(f"__n{i}") for i, k in enumerate(keys)])
        match = [null_safe_key(k) == F.col(f"__n{i}") for i, k in enumerate(keys)]
        merged = scope.join(new, match, "left_anti").unionByName(observe(batch))
    return commit(spark, root, merged, partition_by, check, before)
