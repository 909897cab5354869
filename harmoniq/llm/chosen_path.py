"""N-gram Jaccard join by chosen paths.

A document is the set of its word shingles, embedded as a fixed number of
min-hash tokens.  A run hashes each set down a path: at each node the path
itself chooses which token to read, and sets with the same token stay
together.  Buckets of at most ``bucket_limit`` sets are compared by brute
force; larger ones are split again, up to ``depth`` times.  A pair of
similarity s meets in a run with probability s^(levels read), so ``runs`` is
the number of independent runs after which the chance to miss a pair at the
threshold is below 1 - ``recall``.  Buckets that stay large (groups of near
copies) are compared in blocks of chunks, each pair of chunks a task group.
A pair is compared exactly, on full shingle sets, in the first run in which
it meets, so links are counted once and no list of pairs is ever made.

Results: words are runs of characters other than ASCII white space, A-Z
lower-cased; a text of fewer words than a shingle is one shingle; a text
without words (null, empty) links to nothing and is its own class.  Texts
with equal shingle sets are copies and one class; ``class_id`` is the least
id of the documents connected by copies and links, ``n_links`` the number of
other distinct shingle sets at or above the threshold, ``n_copies`` the rows
of the same set.  Ties need no rule; repeated rows are copies; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import (WordHasher, as_bytes, bounded, by_group, group_starts, mix64, record_batch, store,
                                 text_hash)

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.999
TOKENS = 64
DEPTH = 2
BUCKET_LIMIT = 256
SKETCH_SLACK = 0.3           # six standard deviations of a 64-token estimate at 0.8
_MULTIPLIERS = mix64(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold is missed with probability
    below 1 - recall even if each of its buckets is split to the last level."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** (depth + 1)) - 1e-9))


# ---- sets and sketches -------------------------------------------------------------------
def shingle_sets(texts: list[bytes], hasher: WordHasher, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes per text."""
    words = [t.lower().split() for t in texts]
    flat = hasher([w for ws in words for w in ws])
    out, at = [], 0
    mult = _MULTIPLIERS if width == WIDTH else \
        mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for ws in words:
        n = len(ws)
        w = flat[at:at + n]
        at += n
        if n == 0:
            out.append(np.zeros(0, np.uint64))
            continue
        k = min(n, width)
        s = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            s += w[j:n - k + 1 + j] * mult[j]
        out.append(np.unique(mix64(s)))
    return out


def sketches(sets: list[np.ndarray], tokens: int) -> np.ndarray:
    """Min-hash tokens (sets x tokens, int32) of non-empty sets."""
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    odd = mix64(np.arange(1, tokens + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
    out = np.empty((len(sets), tokens), np.uint32)
    for i in range(tokens):
        out[:, i] = np.minimum.reduceat(((flat * odd[i]) >> np.uint64(32)).astype(np.uint32), at)
    return out.view(np.int32)


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, width: int, tokens: int) -> DataFrame:
    """(id, hash, sid, n, sketch) per row; sid is the 128-bit hash of the set."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]):
        hasher = WordHasher()
        for b in bounded(batches, "text", 1 << 20):
            sets = shingle_sets(as_bytes(b.column("text")), hasher, width)
            full = [i for i, s in enumerate(sets) if len(s)]
            sketch: list = [None] * len(sets)
            if full:
                for i, row in zip(full, sketches([sets[i] for i in full], tokens)):
                    sketch[i] = row
            yield record_batch(["id", "hash", "sid", "n", "sketch"], [
                b.column("id"), b.column("hash"),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                np.array([len(s) for s in sets], np.int32), pa.array(sketch, pa.list_(pa.int32()))])
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), text_hash(text_col).alias("hash"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id bigint, hash bigint, sid binary, n int, sketch array<int>")


# ---- paths ----------------------------------------------------------------------------------
def path_rows(sets: DataFrame, runs: int, tokens: int, depth: int) -> DataFrame:
    """(sid, run, p0 .. p_depth): the nodes of each run's path.  Level 0 of run r
    reads token r; below, the node's own hash chooses among the tokens that
    no run starts with."""
    free = tokens - runs
    if free < 1:
        raise ValueError("more tokens than runs are needed")
    out = sets.select("sid", "sketch", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    out = out.withColumn("p0", F.xxhash64("run", F.get("sketch", F.col("run"))))
    for d in range(1, depth + 1):
        up = F.col(f"p{d - 1}")
        token = (F.pmod(up, F.lit(free)) + runs).cast("int")
        out = out.withColumn(f"p{d}", F.xxhash64(up, F.get("sketch", token)))
    return out.drop("sketch")


def chosen_buckets(sets: DataFrame, runs: int, tokens: int, depth: int, limit: int) -> DataFrame:
    """(sid, run, path, n): each set's last bucket in each run, where it is not
    alone.  Levels below the first see only rows of buckets above the limit."""
    rows, done = path_rows(sets, runs, tokens, depth), []
    for d in range(depth + 1):
        sizes = rows.groupBy(f"p{d}").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
        if d == 0:          # stored, so that Spark can split the join at hot nodes
            sizes = store(sizes, "path-sizes")
        shared = rows.drop("n").join(sizes, f"p{d}")
        if d == 0:
            shared = store(shared, "paths")
        last = d == depth
        done.append(shared.filter(F.lit(True) if last else F.col("n") <= limit)
                    .select("sid", "run", F.col(f"p{d}").alias("path"), "n"))
        rows = shared.filter(F.col("n") > limit)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return store(out, "buckets")


def in_blocks(buckets: DataFrame, limit: int) -> DataFrame:
    """Add (chunk, a, b): a bucket above the limit is dealt over chunks and each
    member joins every pair of chunks that holds its own; others are one block."""
    chunks = F.when(F.col("n") > limit, F.ceil(F.col("n") / limit)).otherwise(F.lit(1)).cast("int")
    x = buckets.withColumn("__c", chunks).withColumn("chunk", F.pmod(F.xxhash64("sid", "path"), F.col("__c")).cast("int"))
    x = x.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__c") - 1)))
    return (x.withColumn("a", F.least("chunk", "__o")).withColumn("b", F.greatest("chunk", "__o"))
            .drop("__c", "__o"))


# ---- comparing inside a block ------------------------------------------------------------------
def first_meetings(vec: np.ndarray, run: int, chunk: np.ndarray, cross: bool) -> np.ndarray:
    """Pairs (i < j) of a block that meet here for the first time: equal keys in
    this run and in no earlier one.  A block of two chunks pairs across them."""
    m = len(vec)
    ok = np.triu(np.ones((m, m), bool), 1)
    if cross:
        ok &= chunk[:, None] != chunk[None, :]
    for r in range(run):
        v = vec[:, r]
        ok &= (v[:, None] != v[None, :]) | (v == 0)[:, None]
    return ok


def similar_tokens(sketch: np.ndarray, least: int) -> np.ndarray:
    same = np.zeros((len(sketch), len(sketch)), np.uint8)
    for t in range(sketch.shape[1]):
        v = sketch[:, t]
        same += v[:, None] == v[None, :]
    return same >= least


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: products of 0/1 blocks over the
    shingles that at least two sets share."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, col, n = np.unique(flat, return_inverse=True, return_counts=True)
    common = n >= 2
    place = np.cumsum(common) - 1
    keep = common[col]
    row, col = row[keep], place[col[keep]]
    width, total = 2048, int(common.sum())
    out = np.zeros((len(sets), len(sets)), np.float64)
    by = np.argsort(col, kind="stable")
    row, col = row[by], col[by]
    cuts = np.searchsorted(col, np.arange(0, total + width, width))
    for i in range(len(cuts) - 1):
        x = np.zeros((len(sets), width), np.float32)
        x[row[cuts[i]:cuts[i + 1]], col[cuts[i]:cuts[i + 1]] - i * width] = 1
        out += x @ x.T
    return out


def local_roots(adjacent: np.ndarray) -> np.ndarray:
    """Least index of each member's connected component."""
    a = adjacent | adjacent.T | np.eye(len(adjacent), dtype=bool)
    label = np.arange(len(a))
    while True:
        new = np.where(a, label[None, :], len(a)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def sets_matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)


def plausible(blocks: DataFrame, runs: int, tokens: int, least: int) -> DataFrame:
    """The block rows whose set has a first meeting with a similar sketch."""
    cols = ["path", "a", "b", "run", "chunk", "sid"]

    def run(table: pa.Table):
        starts = np.append(group_starts(table, ["path", "a", "b"]), table.num_rows)
        vec, sk = sets_matrix(table["vec"], runs, np.int64), sets_matrix(table["sketch"], tokens, np.int32)
        runs_, chunk = table["run"].to_numpy(), table["chunk"].to_numpy()
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        keep = np.zeros(table.num_rows, bool)
        for lo, hi in zip(starts[:-1], starts[1:]):
            if hi - lo < 2:
                continue
            ok = first_meetings(vec[lo:hi], int(runs_[lo]), chunk[lo:hi], a[lo] != b[lo])
            if ok.any():
                ok &= similar_tokens(sk[lo:hi], least)
                keep[lo:hi] = ok.any(axis=0) | ok.any(axis=1)
        out = table.select(cols + ["vec"]).filter(pa.array(keep))
        yield from out.combine_chunks().to_batches()
    schema = "path bigint, a int, b int, run int, chunk int, sid binary, vec array<bigint>"
    return by_group(blocks.select(*cols, "vec", "sketch"), ["path", "a", "b"], ["sid"], run, schema, rows=8_000)


def verify(rows: DataFrame, runs: int, threshold: float) -> DataFrame:
    """(sid, links, root): exact Jaccard of the first meetings of each block."""
    def run(table: pa.Table):
        starts = np.append(group_starts(table, ["path", "a", "b"]), table.num_rows)
        vec = sets_matrix(table["vec"], runs, np.int64)
        runs_, chunk = table["run"].to_numpy(), table["chunk"].to_numpy()
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        sid, packed = table["sid"].to_pylist(), table["shingles"]
        out_sid, out_links, out_root = [], [], []
        for lo, hi in zip(starts[:-1], starts[1:]):
            at = [i for k, i in enumerate(range(lo, hi)) if k == 0 or sid[i] != sid[i - 1]]
            if len(at) < 2:
                continue
            sets = [np.frombuffer(packed[i].as_py(), np.uint64) for i in at]
            size = np.array([len(s) for s in sets], float)
            shared = intersections(sets)
            near = shared * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-9
            near &= first_meetings(vec[at], int(runs_[lo]), chunk[at], a[lo] != b[lo])
            links = near.sum(axis=0) + near.sum(axis=1)
            roots = local_roots(near)
            for k in np.flatnonzero(links):
                out_sid.append(sid[at[k]])
                out_links.append(int(links[k]))
                out_root.append(sid[at[roots[k]]])
        yield record_batch(["sid", "links", "root"], [pa.array(out_sid, pa.binary()), pa.array(out_links, pa.int64()),
                                                      pa.array(out_root, pa.binary())])
    return by_group(rows, ["path", "a", "b"], ["sid"], run, "sid binary, links bigint, root binary", rows=1_500)


# ---- components ---------------------------------------------------------------------------------
def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge (u, v): alternating large and
    small stars, each round a grouped minimum and a join, written to the
    shared folder; ends when the edges no longer change."""
    e = store(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
              "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u != v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v") \
            .filter("u != v").distinct()
        e = store(small, "edges")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == (now["n"], now["s"]):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (now["n"], now["s"])
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


# ---- the join --------------------------------------------------------------------------------------
def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                width: int = WIDTH, recall: float = RECALL, tokens: int = TOKENS, depth: int = DEPTH,
                bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(id, hash, class_id, class_hash, n_links, n_copies) per row of ``docs``;
    (class_id, class_hash) is the least (id, text hash) of the class."""
    runs = runs_for(recall, threshold, depth)
    rows = store(sketch_documents(docs, id_col, text_col, width, tokens), "sketches")
    sets = rows.filter("sid is not null").groupBy("sid").agg(
        F.min(F.struct("id", "hash")).alias("first"), F.min("n").alias("n"), F.min("sketch").alias("sketch"),
        F.count(F.lit(1)).alias("n_copies"))
    sets = store(sets, "sets")
    buckets = chosen_buckets(sets, runs, tokens, depth, bucket_limit)
    found = F.map_from_entries(F.collect_list(F.struct("run", "path")))         # at most one entry per run
    vec = buckets.groupBy("sid").agg(found.alias("m")).select("sid", F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.try_element_at("m", r), F.lit(0))).alias("vec"))
    wide = vec.join(sets.select("sid", "sketch"), "sid")
    blocks = in_blocks(buckets, bucket_limit).join(wide, "sid")
    least = max(1, math.floor((threshold - SKETCH_SLACK) * tokens))
    needed = store(plausible(blocks, runs, tokens, least), "meetings")
    texts = needed.select("sid").distinct().join(sets.select("sid", "first"), "sid")
    shingles = shingles_of(docs, texts, id_col, text_col, width)
    met = store(verify(needed.join(shingles, "sid"), runs, threshold), "links")
    roots = connected(met.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    links = met.groupBy("sid").agg(F.sum("links").alias("n_links"))
    per_set = (sets.select("sid", "first", "n_copies").join(links, "sid", "left")
               .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
               .withColumn("root", F.coalesce("root", "sid")))
    heads = per_set.groupBy("root").agg(F.min("first").alias("head"))
    per_set = per_set.join(heads, "root").select(
        "sid", "head", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    out = rows.select("id", "hash", "sid").join(per_set, "sid", "left")
    own = F.struct("id", "hash")
    head = F.coalesce("head", own)
    return out.select("id", "hash", head["id"].alias("class_id"), head["hash"].alias("class_hash"),
                      F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"))


def shingles_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(sid, shingles) of the representative document of each wanted set."""
    w = wanted.select(F.col("first.id").alias("__id"), F.col("first.hash").alias("__hash"), "sid")
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), text_hash(text_col).alias("hash"),
                      F.col(text_col).cast("string").alias("text"))
    picked = src.join(w, F.col("id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))) \
        .select("sid", "text")

    def run(batches):
        hasher = WordHasher()
        for b in bounded(batches, "text", 1 << 20):
            sets = shingle_sets(as_bytes(b.column("text")), hasher, width)
            yield record_batch(["sid", "shingles"], [b.column("sid"), pa.array([s.tobytes() for s in sets], pa.binary())])
    return picked.mapInArrow(run, "sid binary, shingles binary")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class (the least id); texts without words all stay.
    Columns as they came."""
    found = near_copies(docs, id_col, text_col)
    heads = store(found.groupBy(F.col("class_id").alias("__id"), F.col("class_hash").alias("__hash"))
                  .agg(F.count(F.when(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("hash") == F.col("class_hash")), 1))
                       .alias("__same")), "heads")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                         F.col(id_col).alias("__i"), text_hash(text_col).alias("__h"))

    def rows_of(h: DataFrame) -> DataFrame:
        return marked.join(h, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")))
    once = rows_of(heads.filter("__same = 1"))
    again = rows_of(heads.filter("__same > 1")).dropDuplicates(["__i", "__h"])      # rows equal in id and text
    return once.unionByName(again).select("__row.*")
