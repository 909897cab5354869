"""Soft dedupe - rows whose vectors have a cosine of at least a threshold
inside a block (country, date window, ...) are one class.

Candidates come from random hyperplanes: a band is ``bits`` signs of a vector,
and rows of a block that share a band's signs are compared by exact cosine.
With p = (1 - angle / pi) ** bits, a pair at the threshold shares no band with
probability (1 - p) ** bands; ``plan`` takes as many bands as bring that below
``miss``, and as many bits as make chance meetings rare in the largest block.
Closer pairs are missed less often still, and every kept link is exact.

Vectors are dealt by pairs of chunks of a block, so that a row is shuffled once
per chunk of its block (``CHUNK`` rows), not once per band: the bands are formed
within the task.  Only if the largest block has more chunks than the plan has
bands are rows dealt by band; groups above ``limit`` rows are then split into
chunks and compared chunk against chunk, each pair of chunks in a task of its own.

Pairs never leave a task: it emits, per row, its number of links and the least
row that it is linked with there.  A pair that meets in several bands counts in
the first one only.  Equal vectors of a block are one row with a count before
anything is compared; beside that, rows know their vector by a digest of 128 bits.

Results: rows whose vector is null, empty, zero or holds a null or non-finite
entry, or has another length than ``dims``, stay alone (class of their own, no
links); a null block is a block of its own; repeated ids are refused.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmoniq.operators.classes import connected_classes
from harmoniq.session import materialize

LIMIT = 512
CHUNK = 1 << 16                        # rows of a chunk of a block: with 64 entries 32 MB
TILE = 1 << 22                         # cosines held at once
DENSE = 4                              # what a pair by bands costs, in pairs of a whole product
MAX_BITS = 24


@dataclass(frozen=True)
class Bands:
    bits: int
    bands: int
    miss: float                        # probability that a pair at the threshold shares no band

    def planes(self, dims: int, seed: int = 7) -> np.ndarray:
        return np.random.default_rng(seed).normal(size=(dims, self.bands * self.bits))


def plan(rows: int, threshold: float, miss: float = 1e-5, bits: int | None = None) -> Bands:
    """Bits from the largest block's rows, bands from the threshold and ``miss``."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold lies between 0 and 1")
    if bits is None:
        bits = min(MAX_BITS, max(4, math.ceil(math.log2(max(rows, 2))) + 1))
    p = (1 - math.acos(threshold) / math.pi) ** bits
    bands = max(1, math.ceil(math.log(miss) / math.log1p(-p)))
    return Bands(bits, bands, (1 - p) ** bands)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, block, vector) -> (id, block, digest of the vector); -0.0 is 0.0."""
    for b in batches:
        vector = b.column("vector")
        ends = np.asarray(vector.offsets).astype(np.int64) * 8
        data = (np.asarray(vector.values, np.float64) + 0.0).tobytes()
        marks = [hashlib.blake2b(data[a:z], digest_size=16).digest() for a, z in zip(ends, ends[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("block"), pa.array(marks, pa.binary())],
                                         names=["id", "block", "digest"])


def _marks(v: np.ndarray, planes: np.ndarray, plan_: Bands) -> np.ndarray:
    """The sign pattern of every band, a row of numbers per vector."""
    weights = (1 << np.arange(plan_.bits)).astype(np.int64)
    out = np.empty((len(v), plan_.bands), np.int32)
    for at in range(0, len(v), 2048):
        signs = (v[at:at + 2048] @ planes >= 0).reshape(-1, plan_.bands, plan_.bits)
        out[at:at + 2048] = signs @ weights
    return out


def _signatures(plan_: Bands, dims: int):
    """Unit vectors and the sign pattern of every band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = plan_.planes(dims)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                marks = _marks(np.asarray(part.column("vector").flatten(), np.float64).reshape(part.num_rows, dims), planes, plan_)
                flat = pa.ListArray.from_arrays(np.arange(0, marks.size + 1, plan_.bands, dtype=np.int32),
                                                pa.array(marks.ravel()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("rep", "block", "copies", "vector")], flat],
                                                 names=["rep", "block", "copies", "vector", "marks"])
    return run


def _compare(threshold: float, dims: int):
    """Exact cosines within each (band, block, mark, chunk pair) group."""
    key = ["band", "block", "mark", "low", "high"]

    def links(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        block = table.column("block").combine_chunks().dictionary_encode().indices.to_numpy()
        cols = [block, *[table.column(k).to_numpy() for k in ("band", "mark", "low", "high")]]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        starts = np.flatnonzero(new)
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        chunk, band = table.column("chunk").to_numpy(), table.column("band").to_numpy()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        v = np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(-1, dims)
        marks = np.asarray(table.column("marks").combine_chunks().flatten()).reshape(table.num_rows, -1)
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            x = np.arange(a, b)
            one, two = x[chunk[a:b] == low[a]], x[chunk[a:b] == high[a]]
            i, j = np.nonzero(v[one] @ v[two].T >= threshold)
            i, j = one[i], two[j]
            if low[a] == high[a]:
                i, j = i[i < j], j[i < j]
            if len(i) and band[a]:               # met before in an earlier band: counted there
                first = ~np.any(marks[i, :band[a]] == marks[j, :band[a]], axis=1)
                i, j = i[first], j[first]
            if len(i):
                yield rep, copies, np.stack([i, j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, key):
            out = []
            for rep, copies, (i, j) in links(table):
                members, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                i, j = at[:len(i)], at[len(i):]
                n = np.bincount(i, copies[members[j]], len(members)) + np.bincount(j, copies[members[i]], len(members))
                least = rep[members].copy()      # least row among the links of each, settled within the group
                while True:
                    was = least.copy()
                    np.minimum.at(least, i, least[j])
                    np.minimum.at(least, j, least[i])
                    if np.array_equal(was, least):
                        break
                out.append((rep[members], n.astype(np.int64), least))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 names=["rep", "links", "least"])
    return run


class _Links:
    """Links and least linked rows of the rows of one task, fed by batches of pairs."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.n = copies, np.zeros(len(copies), np.int64)
        self.root = np.arange(len(copies))           # leads straight to the least row of the class so far

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.n, i, self.copies[j])
        np.add.at(self.n, j, self.copies[i])
        self._join(i, j)

    def add_all(self, v: np.ndarray, one: np.ndarray, two: np.ndarray, within: bool, threshold: float) -> None:
        """Links of all rows of ``one`` with all of ``two`` (``within``: the same rows)."""
        across, weights = v[two].T, self.copies[two].astype(np.float64)
        step = max(1, TILE // max(len(two), 1))
        for at in range(0, len(one), step):
            i = one[at:at + step]
            near = v[i] @ across >= threshold
            if within:
                near[np.arange(len(i)), np.arange(at, at + len(i))] = False
            self.n[i] += (near @ weights).astype(np.int64)
            if not within:
                self.n[two] += (self.copies[i].astype(np.float64) @ near).astype(np.int64)
            near &= self.root[i][:, None] != self.root[two]
            a, b = np.nonzero(near)
            self._join(i[a], two[b])

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.root, up := self.root[self.root]):
                self.root = up


def _met_pairs(key: np.ndarray, low: np.ndarray, high: np.ndarray, small: int = 64) -> Iterator[tuple]:
    """Pairs of rows with equal ``key``, as (rows, other rows, paired): ``paired``
    rows lie side by side, otherwise every one is to meet every other.  A row is
    on the low side, on the high side or on both; a pair takes one from each."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    sizes = np.diff(np.append(starts, len(k)))
    for a, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        x = order[a:a + n]
        one, two = x[low[x]], x[high[x]]
        step = max(1, TILE // max(len(two), 1))
        for at in range(0, len(one), step):
            yield one[at:at + step], two, False
    left = np.repeat(sizes <= small, sizes)
    at, far = np.flatnonzero(left), 1
    while len(at := at[at + far < len(k)]) and len(at := at[k[at] == k[at + far]]):
        i, j = order[at], order[at + far]
        meet = (low[i] & high[j]) | (low[j] & high[i])
        yield i[meet], j[meet], True
        far += 1


def _dense_groups(marks: np.ndarray, group: np.ndarray, plan_: Bands, look: int = 8) -> np.ndarray:
    """Groups of rows so alike that their bands (by the first ones) would compare
    more pairs than there are."""
    n = np.bincount(group).astype(np.float64)
    met, seen = np.zeros(len(n)), min(look, plan_.bands)
    for band in range(seen):
        keys, sizes = np.unique((group << plan_.bits) | marks[:, band], return_counts=True)
        met += np.bincount(keys >> plan_.bits, sizes * (sizes - 1.0) / 2, len(n))
    return np.flatnonzero((n > 16) & (met / seen * plan_.bands * DENSE > n * (n - 1) / 2))


def _compare_chunks(plan_: Bands, threshold: float, dims: int):
    """Exact cosines of the rows of a (block, chunk pair) that share a band; of
    all its rows where that takes less."""
    key = ["block", "low", "high"]

    def links(v, marks, group, low, high, found: _Links) -> None:
        two = across = None
        for band in range(plan_.bands):
            for i, j, paired in _met_pairs((group << plan_.bits) | marks[:, band], low, high):
                if paired:
                    near = [np.einsum("nd,nd->n", v[i[p:p + 65536]], v[j[p:p + 65536]]) >= threshold
                            for p in range(0, len(i), 65536)]
                    near = np.concatenate([*near, np.zeros(0, bool)])
                    i, j = i[near], j[near]
                else:
                    if two is not j:
                        two, across = j, v[j].T
                    a, b = np.nonzero(v[i] @ across >= threshold)
                    i, j = i[a], j[b]
                    once = ~(low[i] & high[i]) | (i < j)          # within one chunk both orders come up
                    i, j = i[once], j[once]
                for p in range(0, len(i), 65536):
                    x, y = i[p:p + 65536], j[p:p + 65536]
                    if band:                     # met before in an earlier band: counted there
                        first = ~np.any(marks[x, :band] == marks[y, :band], axis=1)
                        x, y = x[first], y[first]
                    found.add(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = plan_.planes(dims)
        for table in _whole_groups(batches, key):
            table = table.sort_by("rep")             # the least row is the first
            block = table.column("block").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            chunk, lower, upper = (table.column(c).to_numpy() for c in ("chunk", "low", "high"))
            _, group = np.unique(np.stack([block, lower, upper]), axis=1, return_inverse=True)
            v = np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(-1, dims)
            found = _Links(table.column("copies").to_numpy())
            group, low, high, marks = group.ravel(), chunk == lower, chunk == upper, _marks(v, planes, plan_)
            dense = _dense_groups(marks, group, plan_)
            for g in dense:
                x = np.flatnonzero(group == g)
                found.add_all(v, x[low[x]], x[high[x]], bool(lower[x[0]] == upper[x[0]]), threshold)
            rest = ~np.isin(group, dense)
            # rows of dense groups take neither side: they meet nobody by their bands
            links(v, marks, group, low & rest, high & rest, found)
            rep, linked = table.column("rep").to_numpy(), found.n > 0
            if linked.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (rep[linked], found.n[linked], rep[found.root[linked]])],
                    names=["rep", "links", "least"])
    return run


def _whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], rows: int = 8192) -> Iterator[pa.Table]:
    """Runs of whole key groups of a sorted partition."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        other = np.logical_or.reduce([pc.not_equal(t.column(k), t.column(k)[n - 1]).to_numpy() for k in key])
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield t.slice(0, cut)
        held, n = t.slice(cut).to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held)


def candidates(rows: DataFrame, plan_: Bands, dims: int, limit: int = LIMIT) -> DataFrame:
    """Rows (rep, block, copies, vector, marks) -> one row per band in which
    its group has company: (band, block, mark, low, high, chunk, ...).  A row of a
    group above ``limit`` appears once per chunk that its own is compared with."""
    narrow = rows.select("rep", "block", F.posexplode("marks").alias("band", "mark"))
    sizes = narrow.groupBy("band", "block", "mark").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = narrow.join(materialize(sizes), ["band", "block", "mark"])
    chunks = F.ceil(F.col("size") / limit).cast("int")
    chunk = F.pmod(F.xxhash64("rep", "band"), chunks).cast("int")
    met = met.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    met = met.select("rep", "band", "mark", "chunk", F.least("chunk", "other").alias("low"),
                     F.greatest("chunk", "other").alias("high"))
    return met.join(rows, "rep")


def chunk_pairs(rows: DataFrame, sizes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (rep, block, copies, vector) -> one row per chunk of its block, the
    own one included: (..., low, high, chunk).  ``sizes``: (block, count) of the
    blocks above ``chunk`` rows, of which there is one per ``chunk`` rows at most."""
    chunks = F.coalesce(F.ceil(F.col("count") / chunk).cast("int"), F.lit(1))
    dealt = rows.join(F.broadcast(sizes), "block", "left").select(
        "rep", "block", "copies", "vector", F.pmod(F.xxhash64("rep"), chunks).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
    return dealt.select("rep", "block", "copies", "vector", F.least("chunk", "other").alias("low"),
                        F.greatest("chunk", "other").alias("high"), "chunk")


def soft_classes(df: DataFrame, id_col: str, vector: str, block: list[str], threshold: float, dims: int,
                 miss: float = 1e-5, bits: int | None = None, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """(id, class_id, n_links): class_id is the least id of the class, n_links
    the number of other rows of the block within the threshold."""
    x = F.col(vector)
    entries = F.transform(x, lambda c: c.cast("double"))
    norm = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda a, c: a + c * c))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    kept = df.filter((F.size(x) == dims) & whole & (norm > 0))
    place = F.to_json(F.struct(*[F.col(c) for c in block])) if block else F.lit("")
    unit = F.transform(entries, lambda c: c / norm)
    own = kept.select(F.col(id_col).alias("id"), place.alias("block"), unit.alias("vector"))
    named = materialize(own.mapInArrow(_digests, "id bigint, block string, digest binary"))
    groups = materialize(named.groupBy("block", "digest").agg(F.min("id").alias("rep"),
                                                              F.count(F.lit(1)).alias("copies")))
    sizes = groups.groupBy("block").count()
    largest = sizes.agg(F.max("count")).first()[0] or 0
    plan_ = plan(largest, threshold, miss, bits)
    rows = own.groupBy("block", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    rows = rows.filter("rep is not null").select("rep", "block", "copies", "vector")
    if math.ceil(largest / chunk) <= plan_.bands:
        key = ["block", "low", "high"]
        dealt, compare = chunk_pairs(rows, sizes.filter(F.col("count") > chunk), chunk), _compare_chunks(plan_, threshold, dims)
    else:
        key = ["band", "block", "mark", "low", "high"]
        signed = materialize(rows.mapInArrow(
            _signatures(plan_, dims), "rep bigint, block string, copies bigint, vector array<double>, marks array<int>"))
        dealt, compare = candidates(signed, plan_, dims, limit), _compare(threshold, dims)
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)
    found = materialize(dealt.mapInArrow(compare, "rep bigint, links bigint, least bigint"))
    classes = connected_classes(found, "rep", "least")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_rep = (groups.join(links, "rep", "left").join(classes, F.col("rep") == F.col("member"), "left")
              .select("block", "digest", F.coalesce("class", "rep").alias("class_id"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    told = named.join(of_rep, ["block", "digest"]).select("id", "class_id", "n_links")
    return (df.select(F.col(id_col).alias("id")).join(told, "id", "left")
            .select("id", F.coalesce("class_id", "id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")))
