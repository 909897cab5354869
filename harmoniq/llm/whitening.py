"""Whitening of integer vectors with MLlib block matrices.

The distinct vectors are numbered and centred; MLlib groups them into blocks of
consecutive rows.  Transposed blocks times blocks give the scatter matrix (the
inner dimension is split, so every task adds up its own blocks and only d x d
sums meet), the driver diagonalises the d x d covariance, and the blocks times
the whitening matrix give the projections.

Results: vectors that are null or hold a null or non-finite entry are left out
by ``grid``; of the others those with the most frequent length are used (of
equally frequent ones the longest), so vectors of another length go as well.
A vector's copies count once in the fit and all get its projection.
Components are numbered by falling variance; one whose variance is below 1e-11
of the largest cannot be scaled to one and is left out, so vectors that are all
equal, and an empty table, have no components and no rows.  Signs are the same
for all rows.  Columns that are not named take no part.  A vector of more than
``MAX_DIMS`` entries is refused: d x d numbers are diagonalised on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import numbered, store

MAX_DIMS = 2048
ROWS_PER_BLOCK = 1024
# the driver plans products by block, so blocks grow beyond this number of them
MAX_BLOCKS = 65_536
# MLlib deals a grid of one block column out to the square root of the
# partitions of its input: this many squared is what it is given at most
MAX_LANES = 200
LEAST_SHARE = 1e-11


def usable(vector: str) -> Column:
    """True where the vector and all its entries are there and finite."""
    return F.coalesce(F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c)
                               & (F.abs(c.cast("double")) < F.lit(float("inf")))), F.lit(False))


def grid(vector: str, scale: int, offset: int) -> Column:
    """Entries as double, times ``scale``, rounded down, plus ``offset``: longs."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint") + offset)


@dataclass
class Whitening:
    n: int
    sums: list[int]
    variances: np.ndarray             # of the components kept, falling
    explained: np.ndarray
    components: np.ndarray            # d x k, unit columns
    identity_error: float | None
    projected: DataFrame              # (x, whitened): one row per distinct vector


def _dense(spark, values: np.ndarray, parts: int) -> BlockMatrix:
    """A small matrix as one block of an RDD of ``parts`` partitions."""
    block = ((0, 0), DenseMatrix(*values.shape, values.ravel("F")))
    return BlockMatrix(spark.sparkContext.parallelize([block], parts), *values.shape, *values.shape)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """MLlib's product with a split inner dimension (not in the Python signature)."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _covariance(a: BlockMatrix, n: int, splits: int) -> np.ndarray:
    v = _times(a.transpose(), a, splits).toLocalMatrix().toArray() / n
    return (v + v.T) / 2


def fit(vectors: DataFrame, k: int, vector: str = "x", rows_per_block: int = ROWS_PER_BLOCK) -> Whitening:
    """Whiten the distinct vectors of a column of long arrays onto at most
    ``k`` components."""
    spark = vectors.sparkSession
    distinct = vectors.select(F.col(vector).alias("x")).filter("x is not null").distinct()
    rows = store(numbered(distinct, "white-distinct"), "white-fit")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d = most["d"] if most else 0
    if d > MAX_DIMS:
        raise ValueError(f"vectors of {d} entries; at most {MAX_DIMS} can be diagonalised on the driver")
    if most and most["n"] < rows.count():          # other lengths: number the rest anew, without gaps
        rows = store(numbered(rows.filter(F.size("x") == d).select("x"), "white-distinct"), "white-fit")
    n = most["n"] if most else 0
    none = Whitening(n, [0] * d, np.zeros(0), np.zeros(0), np.zeros((d, 0)), None,
                     rows.select("x", F.lit(None).cast("array<double>").alias("whitened")).limit(0))
    if n == 0 or d == 0:
        return none
    sums = [0] * d                                  # d rows
    for r in rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).collect():
        sums[r["pos"]] = r["s"]

    # n * x - S is exact; one division rounds
    centred = F.zip_with("x", F.array(*[F.lit(s) for s in sums]),
                         lambda a, s: (a * F.lit(n) - s).cast("double") / F.lit(float(n)))
    per_block = max(rows_per_block, -(-n // MAX_BLOCKS))
    blocks = -(-n // per_block)
    lanes = max(1, min(blocks, 2 * spark.sparkContext.defaultParallelism, MAX_LANES))
    indexed = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("pos").alias("index"), array_to_vector(centred).alias("vector")), "vector")
    a = IndexedRowMatrix(indexed.repartition(lanes * lanes), n, d).toBlockMatrix(per_block, d)

    v = _covariance(a, n, lanes)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    kept = int(np.sum(e[:k] > max(e[0], 0.0) * LEAST_SHARE))
    none.sums = sums
    if kept == 0:
        return none
    w = u[:, :kept] / np.sqrt(e[:kept])
    # projections of centred rows are centred: their covariance needs no further mean
    c = _times(a, _dense(spark, w, lanes * lanes), 1)
    error = float(np.abs(_covariance(c, n, lanes) - np.eye(kept)).max())
    back = callMLlibFunc("getIndexedRows", c.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    back = back.toDF("pos", "vector").select("pos", vector_to_array("vector").alias("whitened"))
    projected = store(rows.join(back, "pos").select("x", "whitened"), "white-projected")
    return Whitening(n, sums, e[:kept], e[:kept] / np.trace(v), u[:, :kept], error, projected)


def project(rows: DataFrame, w: Whitening, vector: str = "x") -> DataFrame:
    """The rows whose vector took part, with ``whitened`` (one number per
    component) and ``deviation``: the sum of (n * x - S)^2, an exact long."""
    from harmoniq.llm.common import without
    n = F.lit(w.n)
    apart = F.zip_with("x", F.array(*[F.lit(s) for s in w.sums]).cast("array<bigint>"), lambda a, s: a * n - s)
    far = F.aggregate(apart, F.lit(0).cast("bigint"), lambda acc, t: acc + t * t)
    found = w.projected.select(F.col("x").alias("__x"), "whitened", far.alias("deviation"))
    kept = without(rows, "whitened", "deviation", "__x")
    return kept.join(found, F.col(f"`{vector}`") == F.col("__x")).drop("__x")
