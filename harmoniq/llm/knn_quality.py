"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become hashed counts of letter trigrams, of character-class 5-grams and
of immediate word repetitions, weighted by log counts and inverse document
frequency; a truncated singular value decomposition of the labelled
sample gives the latent space.  The labelled vectors are broadcast; every
document's cosine to each of them is computed exactly, in blocks, and the
labels of the nearest vote with their similarity as weight.

Bounds (documented parameters): at most ``max_labelled`` labelled rows are
fitted on and broadcast, half of each label where there are enough, chosen by
the hash of the text (equal texts of one label are one row); the vote is weighted back to the labels' shares
over all labelled training rows.  Every document is scored over its whole text.

Results: null and empty texts, and any text without features, score the share of
label 1 (0.5 if nothing was learned); null labels teach nothing; of equal
similarities the labelled row first in hash order counts; repeated rows score
alike; input columns named like a produced column are replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import as_bytes, bounded, record_batch, text_hash, utf8, without

GRAM_BITS, SHAPE_BITS, REPEATS = 12, 10, 8
FEATURES = (1 << GRAM_BITS) + (1 << SHAPE_BITS) + REPEATS
MAX_LABELLED = 2400
MAX_LABELLED_BYTES = 64 << 20
RANK = 64
NEIGHBOURS = 31
# character classes: space, lower, upper, digit, other ASCII, from 0x80
_CLASS = np.full(256, 4, np.uint32)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[128:] = 5


def features(data: np.ndarray, off: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Feature counts, one row per text (float32)."""
    n = len(off) - 1
    out = np.zeros((n, FEATURES), np.float32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    if len(data) >= 3:
        x = data.astype(np.uint32)
        gram = (x[:-2] | (x[1:-1] << np.uint32(8)) | (x[2:] << np.uint32(16))) * np.uint32(2654435761)
        same = doc[:-2] == doc[2:]
        at = (doc[:-2] << GRAM_BITS) + (gram >> np.uint32(32 - GRAM_BITS))
        out[:, :1 << GRAM_BITS] = np.bincount(at[same], minlength=n << GRAM_BITS).reshape(n, -1)
    if len(data) >= 5:
        c = _CLASS[data]
        shape = c[:-4]
        for j in range(1, 5):
            shape = shape * np.uint32(6) + c[j:len(c) - 4 + j]
        slot = (shape * np.uint32(2246822519)) >> np.uint32(32 - SHAPE_BITS)
        same = doc[:-4] == doc[4:]
        at = (doc[:-4] << SHAPE_BITS) + slot
        out[:, 1 << GRAM_BITS:-REPEATS] = np.bincount(at[same], minlength=n << SHAPE_BITS).reshape(n, -1)
    for i, t in enumerate(texts):
        w = t.lower().split()
        if len(w) > 1:
            again = sum(map(bytes.__eq__, w[:-1], w[1:])) / (len(w) - 1)
            if again:
                out[i, -REPEATS + min(REPEATS - 1, int(again * REPEATS * 2))] = len(w)
    return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def batch_features(b: pa.RecordBatch, column: str) -> np.ndarray:
    return features(*utf8(b.column(column)), as_bytes(b.column(column)))


# ---- fitting ---------------------------------------------------------------------------
def labelled_sample(train: DataFrame, labels: DataFrame | None, label_col: str, text_col: str, id_col: str,
                    max_labelled: int) -> tuple[DataFrame, dict]:
    """At most ``max_labelled`` (text, label) rows and the label shares.  The
    sample is drawn on hashes; only the drawn texts are brought together."""
    rows = train.select(*([F.col(id_col).alias("id")] if labels is not None else [F.col(label_col).alias("label")]),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", text_hash("text"))
    keyed = rows.select("h", "label") if labels is None else \
        rows.select("id", "h").join(labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")), "id")
    keyed = keyed.filter(F.col("label").isin(0, 1)).select("h", F.col("label").cast("int").alias("label"))
    share = {r["label"]: r["count"] for r in keyed.groupBy("label").count().collect()}
    least = min(share.values(), default=0)
    drawn = rows.sparkSession.createDataFrame([], "h bigint, label int")
    for k, n in sorted(share.items()):
        take = min(n, max(max_labelled // 2, max_labelled - least))
        drawn = drawn.unionByName(keyed.filter(F.col("label") == k).distinct().orderBy("h").limit(take))
    # at most max_labelled rows of two numbers
    texts = rows.select("h", "text").join(F.broadcast(drawn), "h")
    return texts.groupBy("h", "label").agg(F.any_value("text").alias("text")), share


def fit(train: DataFrame, label_col: str = "quality", text_col: str = "text", max_labelled: int = MAX_LABELLED,
        rank: int = RANK, max_bytes: int = MAX_LABELLED_BYTES, labels: DataFrame | None = None,
        id_col: str = "doc_id") -> dict:
    """Latent space and labelled vectors, from rows with a label column or from
    rows and ``labels`` (id, label).  The sample's feature rows are made in
    the tasks, so long texts do not reach the driver."""
    sample, share = labelled_sample(train, labels, label_col, text_col, id_col, max_labelled)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in bounded(batches, "text", 1 << 20, 256):
            x = batch_features(b, "text")
            sparse = [np.flatnonzero(r) for r in x]
            yield record_batch(["label", "slot", "n"], [
                b.column("label"), pa.array([s.astype(np.int32) for s in sparse], pa.list_(pa.int32())),
                pa.array([r[s] for r, s in zip(x, sparse)], pa.list_(pa.float32()))])
    got = sample.select("label", "text").mapInArrow(run, "label int, slot array<int>, n array<float>").toArrow()
    if got.nbytes > max_bytes * 2:
        raise ValueError(f"the labelled sample takes {got.nbytes} bytes; lower max_labelled")
    x = np.zeros((got.num_rows, FEATURES), np.float32)
    for i, (s, n) in enumerate(zip(got.column("slot").to_pylist(), got.column("n").to_pylist())):
        x[i, s] = n
    label = got.column("label").to_numpy().astype(np.int64)
    order = np.lexsort(np.concatenate([x[:, :64].T, label[None, :]]))       # independent of task order
    x, label = x[order], label[order]
    if len(x) == 0:
        return {"prior": 0.5, "label": label}
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    w = weigh(x, idf)
    values, vectors = np.linalg.eigh((w @ w.T).astype(np.float64))
    top = np.argsort(-values)[:rank]
    top = top[values[top] > 1e-6]
    space = (w.T @ (vectors[:, top] / np.sqrt(values[top])).astype(np.float32)).astype(np.float32)
    total = sum(share.values())
    seen = np.maximum(np.bincount(label, minlength=2), 1)
    weight = np.array([share.get(0, 0) / total / seen[0], share.get(1, 0) / total / seen[1]])
    return {"prior": share.get(1, 0) / total, "label": label, "idf": idf, "space": space,
            "vectors": unit(w @ space).astype(np.float32), "weight": (weight / weight.max()).astype(np.float32)}


# ---- scoring ----------------------------------------------------------------------------
def vote(query: np.ndarray, model: dict, k: int = NEIGHBOURS, block: int = 1024) -> np.ndarray:
    """Share of label 1 among the k nearest labelled vectors, by similarity;
    cosines to all vectors are products of blocks, the best k so far are kept."""
    vectors, label = model["vectors"], model["label"]
    best = np.full((len(query), 0), 0, np.float32)
    whose = np.zeros((len(query), 0), np.int64)
    for lo in range(0, len(vectors), block):
        sim = np.concatenate([best, query @ vectors[lo:lo + block].T], axis=1)
        who = np.concatenate([whose, np.broadcast_to(np.arange(lo, min(lo + block, len(vectors))),
                                                     (len(query), min(block, len(vectors) - lo)))], axis=1)
        if sim.shape[1] > k:
            at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            sim, who = np.take_along_axis(sim, at, 1), np.take_along_axis(who, at, 1)
        best, whose = sim, who
    near = np.maximum(best, 0) ** 4 * model["weight"][label[whose]]        # closer neighbours count far more
    total = near.sum(axis=1)
    return np.where(total > 0, (near * label[whose]).sum(axis=1) / np.maximum(total, 1e-12), model["prior"])


def score(docs: DataFrame, model: dict, text_col: str = "text", keep: list[Column | str] | None = None,
          threshold: float = 0.7) -> DataFrame:
    """Append score and predicted to the rows (or to the columns of ``keep``)."""
    made = ("score", "predicted")
    src = (docs if keep is None else docs.select(*keep, F.col(text_col)))
    src = src.withColumn("__text", F.col(text_col).cast("string"))
    src = without(src, *made, *([text_col] if keep is not None else []))
    out_cols = [c for c in src.columns if c != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text"]
                       + ["score double", "predicted int"])
    shared = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        m = shared.value
        for b in bounded(batches, "__text", 1 << 20, 256):
            if len(m["label"]):
                x = batch_features(b, "__text")
                s = vote(unit(weigh(x, m["idf"]) @ m["space"]), m)
                s = np.where(x.any(axis=1), s, m["prior"]).astype(np.float64)
            else:
                s = np.full(b.num_rows, m["prior"])
            s = np.clip(s, 0, 1)
            yield record_batch(out_cols + list(made), [b.column(c) for c in out_cols] + [s, (s >= threshold).astype(np.int32)])
    return src.mapInArrow(run, schema)
