"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores the corpus as index segments: each segment holds the
documents of one run of rows (a bounded number of words) and, for every term
of the benchmark vocabulary, the sorted positions at which it occurs.
``search`` hands each segment the benchmark's phrases: it starts from the
positions of a phrase's rarest term in the segment and intersects them with
the other terms' lists, each shifted by the term's offset, in order of rarity.
With ``slop`` 0 that finds exact phrases, with ``slop`` s phrases whose terms
lie within s words of their place (proximity).

Bounds: phrases are sent in blocks of at most ``block_words`` words; a
benchmark of more words takes several passes over the stored index, whose
covered spans are merged per document.  A segment holds at most
``segment_words`` words, or one longer document.

Results: null and empty texts, and items without a word, have no words and
match nothing; a repeated document row is judged by itself; a repeated item id
counts once; items with a null id cover words as others do and add no id to the
list; items of fewer words than a phrase are one phrase; an empty table
on either side gives no hits; other columns are ignored.  Whole texts are
indexed whatever their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import as_bytes, bounded, record_batch, store, text_hash

# fixed value: words after lower-casing A-Z, over UTF-8 bytes (all bytes from
# 0x80 belong to words)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PHRASE = 10
SEGMENT_WORDS = 400_000
BLOCK_WORDS = 1_000_000
GAP = 64                     # free positions between documents; slop stays below it
SEGMENT = ("keys array<string>, doc_ids array<bigint>, starts binary, words binary, terms binary, counts binary, "
           "positions binary")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


# ---- the benchmark side ----------------------------------------------------------------
def phrase_blocks(benchmark: DataFrame, item_col: str, text_col: str, n: int, block_words: int) -> Iterator[tuple]:
    """(phrases, items): lists of word tuples and of item ids, block by block.
    A block ends within an item if need be, so no item makes a larger one."""
    phrases, items, held, any_block = [], [], 0, False
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    for r in rows.filter("text is not null").toLocalIterator():
        w = words_of(r["text"].encode("utf-8"))
        if not w:
            continue
        for i in range(max(1, len(w) - n + 1)):
            held += 1 if i and phrases else len(w[i:i + n])      # a further phrase of an item adds one word
            phrases.append(tuple(w[i:i + n]))
            items.append(r["item"])
            if held >= block_words:
                yield phrases, items
                phrases, items, held, any_block = [], [], 0, True
    if phrases or not any_block:
        yield phrases, items


def compile_phrases(phrases: list[tuple], items: list[str], vocabulary: dict[bytes, int]) -> dict:
    """Distinct phrases as padded term-id rows, and which items hold them."""
    at: dict[tuple, int] = {}
    pairs = sorted(x for x in {(at.setdefault(p, len(at)), i) for p, i in zip(phrases, items)} if x[1] is not None)
    width = max(map(len, at), default=1)
    terms = np.full((len(at), width), -1, np.int64)
    for p, k in at.items():
        terms[k, :len(p)] = [vocabulary[w] for w in p]
    return {"terms": terms, "length": (terms >= 0).sum(axis=1), "pair_phrase": np.array([p for p, _ in pairs], np.int64),
            "pair_item": [i for _, i in pairs]}


# ---- the corpus side ---------------------------------------------------------------------
def index_segment(keys: list, ids: list, texts: list[bytes], vocabulary: dict[bytes, int]) -> list:
    """One segment row: positions per term over the run's documents."""
    get = vocabulary.get
    starts, counts, at, found = [], [], 0, []
    for t in texts:
        w = words_of(t)
        starts.append(at)
        counts.append(len(w))
        if w:
            term = np.fromiter((get(x, -1) for x in w), np.int64, len(w))
            pos = np.flatnonzero(term >= 0)
            found.append((term[pos] << 40) | (pos + at))
        at += len(w) + GAP
    key = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    term, n = np.unique(key >> 40, return_counts=True)
    return [keys, ids, np.array(starts, np.int64).tobytes(), np.array(counts, np.int64).tobytes(),
            term.astype(np.int32).tobytes(), n.astype(np.int64).tobytes(), (key & ((1 << 40) - 1)).astype(np.int32).tobytes()]


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Store the index segments in the shared folder; map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [f.strip().split()[0] for f in SEGMENT.split(", ")]

    def build(batches):
        for b in bounded(batches, "text", segment_words * 6):
            ids = b.column("id")
            row = index_segment(b.column("key").to_pylist(), ids.to_pylist(), as_bytes(b.column("text")), shared.value)
            yield record_batch(names, [pa.array([row[0]], pa.list_(pa.string())), pa.array([row[1]], pa.list_(pa.int64()))]
                               + [pa.array([x], pa.binary()) for x in row[2:]])
    src = docs.select(text_hash(text_col).cast("string").alias("key"), F.col(id_col).cast("bigint").alias("id"),
                      F.col(text_col).cast("string").alias("text"))
    return store(src.mapInArrow(build, SEGMENT), "postings")


def intersect(query: dict, term: np.ndarray, count: np.ndarray, position: np.ndarray, slop: int) -> tuple:
    """(phrase, start) of every match in a segment."""
    n_terms = int(max(term.max(initial=-1), query["terms"].max(initial=-1))) + 1
    df = np.zeros(n_terms + 1, np.int64)
    df[term] = count
    begin = np.zeros(n_terms + 1, np.int64)
    begin[term] = np.cumsum(count) - count
    key = (np.repeat(term.astype(np.int64), count) << 40) | position
    t = query["terms"]
    n = np.where(t >= 0, df[t], np.iinfo(np.int64).max)            # padding is never the rarest
    alive = np.flatnonzero((n > 0).all(axis=1))
    if not len(alive):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(n[alive], axis=1, kind="stable")
    first = order[:, 0]
    t0 = t[alive, first]
    phrase = np.repeat(np.arange(len(alive)), df[t0])              # candidates: the rarest term's positions
    within = np.arange(len(phrase)) - np.repeat(np.cumsum(df[t0]) - df[t0], df[t0])
    start = position[begin[t0][phrase] + within] - first[phrase]
    ok = start >= 0
    phrase, start = phrase[ok], start[ok]
    for step in range(1, t.shape[1]):
        offset = order[phrase, step]
        want = t[alive[phrase], offset]
        base = (want << 40) + start + offset
        lo = np.searchsorted(key, base - slop, "left")
        hit = (want < 0) | ((lo < len(key)) & (key[np.minimum(lo, len(key) - 1)] <= base + slop))
        phrase, start = phrase[hit], start[hit]
        if not len(phrase):
            break
    return alive[phrase], start


def search(index: DataFrame, query: dict, slop: int = 0) -> DataFrame:
    """(key, id, n_words, spans, items) for each indexed document: the merged
    covered word spans [from, to) and the ids of the items found."""
    if slop >= GAP // 2:
        raise ValueError("slop must stay below half the gap between documents")
    shared = index.sparkSession.sparkContext.broadcast(query)

    def find(batches):
        q = shared.value
        by_phrase = np.searchsorted(q["pair_phrase"], np.arange(len(q["terms"]) + 1))
        for b in batches:
            for r in b.to_pylist():
                starts, words = np.frombuffer(r["starts"], np.int64), np.frombuffer(r["words"], np.int64)
                phrase, start = intersect(q, np.frombuffer(r["terms"], np.int32), np.frombuffer(r["counts"], np.int64),
                                          np.frombuffer(r["positions"], np.int32).astype(np.int64), slop) if len(q["terms"]) else \
                    (np.zeros(0, np.int64), np.zeros(0, np.int64))
                doc = np.searchsorted(starts, start + slop, "right") - 1
                size = len(starts)
                spans, items = [[] for _ in range(size)], [set() for _ in range(size)]
                for d, p, s in sorted(zip(doc.tolist(), phrase.tolist(), (start - starts[doc]).tolist()),
                                      key=lambda x: (x[0], x[2])):
                    lo, hi = max(0, s - slop), min(int(words[d]), s + int(q["length"][p]) + slop)
                    if spans[d] and spans[d][-1][1] >= lo:
                        spans[d][-1][1] = max(spans[d][-1][1], hi)
                    else:
                        spans[d].append([lo, hi])
                    items[d].update(q["pair_item"][by_phrase[p]:by_phrase[p + 1]])
                span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
                yield record_batch(["key", "id", "n_words", "spans", "items"], [
                    pa.array(r["keys"], pa.string()), pa.array(r["doc_ids"], pa.int64()), words,
                    pa.array([[{"from": a, "to": z} for a, z in s] for s in spans], pa.list_(span)),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string()))])
    return index.mapInArrow(find, "key string, id bigint, n_words bigint, "
                                  "spans array<struct<from: bigint, to: bigint>>, items array<string>")


def merge_passes(found: list[DataFrame]) -> DataFrame:
    """Join the passes of a benchmark of several blocks: per document the
    union of spans and items.  Every pass lists every row, so equal rows are
    told apart by nothing and need not be: they have equal spans."""
    if len(found) == 1:
        return found[0]
    both = found[0]
    for f in found[1:]:
        both = both.unionByName(f)
    per = both.groupBy("key", "id").agg(
        (F.count(F.lit(1)) / len(found)).cast("bigint").alias("__rows"), F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

    def union(batches):
        for b in batches:
            merged = []
            for spans in b.column("spans").to_pylist():
                out: list = []
                for s in sorted(spans, key=lambda x: x["from"]):
                    if out and out[-1]["to"] >= s["from"]:
                        out[-1]["to"] = max(out[-1]["to"], s["to"])
                    else:
                        out.append(dict(s))
                merged.append(out)
            cols = {n: b.column(n) for n in b.schema.names}
            cols["spans"] = pa.array(merged, b.schema.field("spans").type)
            yield record_batch(list(cols), list(cols.values()))
    return (per.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__rows").cast("int")))).drop("__k", "__rows")
            .select("key", "id", "n_words", "spans", "items")
            .mapInArrow(union, "key string, id bigint, n_words bigint, "
                               "spans array<struct<from: bigint, to: bigint>>, items array<string>"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", n: int = PHRASE, slop: int = 0,
                       block_words: int = BLOCK_WORDS, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """(key, id, n_words, spans, items) per document row; ``key`` is the text's hash."""
    found = []
    for phrases, items in phrase_blocks(benchmark, item_col, item_text_col, n, block_words):
        # each block's vocabulary has its own index: the postings of the block's terms
        vocabulary = {w: i for i, w in enumerate(sorted({w for p in phrases for w in p}))}
        index = build_index(docs, vocabulary, id_col, text_col, segment_words)
        found.append(search(index, compile_phrases(phrases, items, vocabulary), slop))
    return merge_passes(found)


def digest_items(items: list[list[str]]) -> list[str]:
    return [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark phrase; columns as they came."""
    bad = find_contamination(docs, benchmark, text_col=text_col).filter(F.size("spans") > 0) \
        .select(F.col("key").cast("bigint").alias("__bad")).distinct()
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), text_hash(text_col).alias("__h"))
    return marked.join(bad, F.col("__h") == F.col("__bad"), "left_anti").select("__row.*")
