"""Repeated-passage removal by two-stage suffix sorting.

A byte goes when some ``span``-byte string over it starts at least twice in
the corpus.  Candidate windows are found by content-chosen anchors: every
window holds the least-hashed ``gram``-byte string in it, so equal windows
share an anchor and an anchor seen once cannot lie in a repeated window.
The windows of repeated anchors are cut out as segments (each window in the
segment of its own anchor), equal segments are counted as one with a
multiplicity, and the segments of an anchor come together in one task.

There the segments' text is suffix-sorted in two stages: only suffixes smaller than
their successors are sorted directly; the others are induced from them by
scanning the buckets of the first byte in order.  Common prefixes of
neighbours then tell which windows repeat.  An anchor with more than
``group_limit`` different segments is split before it is brought together: its
windows are dealt by their offset to the anchor and by a hash of the bytes
that all windows of that offset range share, range by range down to single
offsets, where equal windows are one row.

Results: texts are UTF-8 bytes; null and empty texts have no bytes; texts
shorter than the span keep all bytes; matches never cross documents; rows equal in
id and text are occurrences of each other; strings are judged on the input;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import bounded, by_group, mix64, record_batch, store, text_hash, utf8

SPAN, GRAM = 200, 64
GROUP_LIMIT = 4000
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


# ---- anchors -----------------------------------------------------------------------------
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if n in _POWERS:
        return _POWERS[n]
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    _POWERS.clear()
    _POWERS[n] = np.cumprod(up), np.cumprod(down)
    return _POWERS[n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of data[p:p + gram] for every p (rolling polynomial, mixed)."""
    n = len(data)
    up, down = _powers(1 << max(21, int(n).bit_length()))
    c = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=c[1:])
    return mix64((c[gram:] - c[:-gram]) * down[:n - gram + 1])


def segments(data: np.ndarray, off: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(doc, first, last, hash, place): runs of window starts [first, last] that
    share the leftmost least-hashed gram, with that gram's hash and place."""
    empty = np.zeros(0, np.int64)
    if len(data) < span:
        return empty, empty, empty, np.zeros(0, np.uint64), empty
    h = gram_hashes(data, gram)
    width = span - gram + 1
    m = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while have * 2 <= width:
        m = np.minimum(m[:len(m) - have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[:len(m) - (width - have)], m[width - have:])
    anchor = (m & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    inside = doc[:len(anchor)] == doc[span - 1:span - 1 + len(anchor)]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1]) | (doc[1:len(anchor)] != doc[:len(anchor) - 1])
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1]) | (doc[1:len(anchor)] != doc[:len(anchor) - 1])
    first, last = np.flatnonzero(start), np.flatnonzero(stop)
    return doc[first].astype(np.int64), first, last, h[anchor[first]], anchor[first]


# ---- two-stage suffix sorting ----------------------------------------------------------------
def words_at(text: np.ndarray, reach: int) -> np.ndarray:
    """Big-endian 8-byte word at every position, zero-padded by ``reach``."""
    t = np.concatenate([text, np.zeros(reach + 8, np.uint8)]).astype(np.uint64)
    n = len(text) + reach
    w = t[:n].copy()
    for j in range(1, 8):
        w <<= np.uint64(8)
        w |= t[j:n + j]
    return w


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor (equal bytes decide
    as the first different pair after them; the end is the smallest)."""
    n = len(text)
    at = np.arange(n)
    change = np.append(text[:-1] != text[1:], True)
    nxt = np.minimum.accumulate(np.where(change, at, n)[::-1])[::-1]
    return np.append(text, 0)[nxt] < np.append(text, 0)[np.minimum(nxt + 1, n)] if n else np.zeros(0, bool)


def sort_directly(pos: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` bytes, 8 at a time; only ties
    are sorted further."""
    if not len(pos):
        return pos
    pos = pos[np.argsort(word[pos])]
    group = np.cumsum(np.append(True, word[pos][1:] != word[pos][:-1]))
    size = np.bincount(group)
    tied = np.flatnonzero(size[group] > 1)
    group = group[tied]
    for d in range(8, depth, 8):
        if not len(tied):
            break
        p = pos[tied]
        k = word[p + d]
        order = np.lexsort((k, group))
        p, k, group = p[order], k[order], group[order]
        pos[tied] = p
        new = np.cumsum(np.append(True, (k[1:] != k[:-1]) | (group[1:] != group[:-1])))
        size = np.bincount(new)
        keep = size[new] > 1
        tied, group = tied[keep], new[keep]
    return pos


def two_stage_sort(text: np.ndarray, wanted: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
    """The ``wanted`` positions (bool mask) in suffix order, to ``depth`` bytes."""
    n = len(text)
    direct = smaller_than_next(text)
    # an induced suffix needs its successors up to the next directly sorted one
    need = wanted.copy()
    next_direct = np.minimum.accumulate(np.where(direct, np.arange(n), n)[::-1])[::-1]
    reach = np.zeros(n + 2, np.int32)
    at = np.flatnonzero(wanted & ~direct)
    np.add.at(reach, at, 1)
    np.add.at(reach, np.minimum(next_direct[at] + 1, n), -1)
    need |= np.cumsum(reach[:n]) > 0
    sorted_ = sort_directly(np.flatnonzero(need & direct), word, depth)
    first = text[sorted_]
    cut = np.searchsorted(first, np.arange(257))
    induced = need & ~direct
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and induced[n - 1]:                                     # the end precedes everything
        waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        bucket = []
        while len(wave):                                         # runs of the same byte, shortest first
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (text[before] == c)]
        bucket.append(sorted_[cut[c]:cut[c + 1]])
        row = np.concatenate(bucket)
        if not len(row):
            continue
        out.append(row)
        before = row[row > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        if len(before):
            byte = text[before]
            order = np.argsort(byte, kind="stable")
            before, byte = before[order], byte[order]
            starts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
            for s, e in zip(starts, np.append(starts[1:], len(byte))):
                waiting[byte[s]].append(before[s:e])
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(order: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, in whole 8-byte
    words up to ``depth``."""
    lcp = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for d in range(0, depth, 8):
        live = live[word[order[live] + d] == word[order[live - 1] + d]]
        if not len(live):
            break
        lcp[live] = d + 8
    return lcp


def repeated_windows(text: np.ndarray, wanted: np.ndarray, span: int) -> np.ndarray:
    """Mask of wanted positions whose ``span`` bytes start at another wanted one."""
    if span % 8:
        raise ValueError("span must be a multiple of 8")
    word = words_at(text, span)
    order = two_stage_sort(text, wanted, span, word)
    same = common_prefixes(order, word, span) >= span
    hit = np.zeros(len(text), bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    return hit


# ---- distributed operator ------------------------------------------------------------------------
SEGMENT = "key bigint, sub bigint, n bigint, rel int, windows int, bytes binary"
SEGMENT_COLUMNS = [c.split()[0] for c in SEGMENT.split(", ")]
SEGMENT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def packed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, doc, text): doc is a 64-bit hash of id and text.  Two documents under
    one hash only share candidates; the last step checks every segment."""
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(id_col, text_hash(text_col)).alias("doc"),
                       F.col(text_col).cast("string").alias("text"))


def cut_segments(b: pa.RecordBatch, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """doc index, first, windows, anchor, skey, the anchor's place in the segment and
    the bytes of a batch's segments."""
    import xxhash
    data, off = utf8(b.column("text"))
    doc, first, last, h, place = segments(data, off, span, gram)
    raw = data.tobytes()
    cut = [raw[a:z] for a, z in zip(first.tolist(), (last + span).tolist())]
    skey = np.fromiter(map(xxhash.xxh3_64_intdigest, cut), np.uint64, len(cut))
    return doc, first - off[doc], (last - first + 1).astype(np.int32), h, skey, (place - first).astype(np.int32), cut


def anchor_counts(rows: DataFrame, span: int, gram: int) -> DataFrame:
    """(anchor, n): occurrences, added up per run of texts."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in bounded(batches, "text", CHUNK):
            h, n = np.unique(segments(*utf8(b.column("text")), span, gram)[3], return_counts=True)
            yield record_batch(["anchor", "n"], [h.view(np.int64), n.astype(np.int32)])
    return rows.select("text").mapInArrow(run, "anchor bigint, n int")


def occurrences(rows: DataFrame, span: int, gram: int) -> DataFrame:
    """(anchor, skey, doc, at, windows) of every window run whose anchor occurs twice."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in bounded(batches, "text", CHUNK):
            doc, at, windows, h, skey, _, _ = cut_segments(b, span, gram)
            yield record_batch(["anchor", "skey", "doc", "at", "windows"], [
                h.view(np.int64), skey.view(np.int64), b.column("doc").to_numpy()[doc], at.astype(np.int32), windows])
    found = rows.select("doc", "text").mapInArrow(run, "anchor bigint, skey bigint, doc bigint, at int, windows int")
    twice = anchor_counts(rows, span, gram).groupBy("anchor").agg(F.sum("n").alias("seen")).filter("seen >= 2")
    # stored, so that the join's two sides are plain shuffles which Spark can split at hot anchors
    return found.join(store(twice.select("anchor"), "anchors"), "anchor")


def squeezed(rows: DataFrame) -> DataFrame:
    """(id, doc, packed): texts compressed before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]):
        import zstandard
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in bounded(batches, "text", CHUNK):
            yield record_batch(["id", "doc", "packed"], [b.column("id"), b.column("doc"), pa.array(
                [None if t is None else pack(t) for t in b.column("text").cast(pa.binary()).to_pylist()], pa.binary())])
    return rows.mapInArrow(run, "id bigint, doc bigint, packed binary")


def representatives(rows: DataFrame, distinct: DataFrame, span: int, gram: int) -> DataFrame:
    """(key, sub, n, rel, windows, bytes): each distinct segment (key: its anchor,
    sub: its hash, rel: the anchor's place), cut from one document that holds it."""
    wanted = distinct.groupBy("doc").agg(F.collect_list(F.struct("anchor", "skey", "n")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]):
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                text = pa.array([unpack(t) for t in part.column("packed").to_pylist()], pa.binary()).cast(pa.string())
                for b in bounded(iter([part.append_column("text", text)]), "text", CHUNK):
                    lists = [{(w["anchor"], w["skey"]): w["n"] for w in x} for x in b.column("wanted").to_pylist()]
                    doc, _, windows, h, skey, rel, cut = cut_segments(b, span, gram)
                    out = []
                    for i, (d, a, k) in enumerate(zip(doc.tolist(), h.view(np.int64).tolist(),
                                                      skey.view(np.int64).tolist())):
                        n = lists[d].pop((a, k), None)
                        if n is not None:
                            out.append((a, k, n, int(rel[i]), int(windows[i]), cut[i]))
                    yield record_batch(SEGMENT_COLUMNS, [pa.array([o[j] for o in out], t)
                                                         for j, t in enumerate(SEGMENT_TYPES)])
    texts = squeezed(rows).select("doc", "packed").join(wanted, "doc").select("packed", "wanted")
    return texts.mapInArrow(run, SEGMENT)


def ranges_of(hit: np.ndarray, off: np.ndarray, span: int) -> pa.Array:
    """Per segment, the covered byte ranges of its window starts in ``hit``."""
    at = np.flatnonzero(hit)
    of = np.searchsorted(off, at, "right") - 1
    new = np.append(True, (np.diff(at) > span) | (of[1:] != of[:-1]))[:len(at)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    lo, hi = at[first] - off[of[first]], at[last] - off[of[first]] + span
    place = np.searchsorted(of[first], np.arange(len(off)))
    values = pa.StructArray.from_arrays([pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["from", "to"])
    return pa.ListArray.from_arrays(pa.array(place.astype(np.int32)), values)


RANGES = "array<struct<from: int, to: int>>"


def judge_segments(distinct: DataFrame, span: int) -> DataFrame:
    """(key, sub, ranges): the repeated parts of each distinct segment, by
    suffix-sorting the segments of the keys of a pack."""
    def run(table: pa.Table):
        raw = table["bytes"].combine_chunks()
        data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
        off = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
        text = data[off[0]:off[-1]]
        off = off - off[0]
        windows = table["windows"].to_numpy().astype(np.int64)
        edge = np.zeros(len(text) + 1, np.int32)
        edge[off[:-1]] += 1
        np.add.at(edge, off[:-1] + windows, -1)
        wanted = np.cumsum(edge[:-1]) > 0
        hit = repeated_windows(text, wanted, span)
        several = np.repeat(table["n"].to_numpy() > 1, np.diff(off))
        ranges = ranges_of(hit | (wanted & several), off, span)
        some = np.diff(ranges.offsets.to_numpy()) > 0
        out = table.select(["key", "sub"]).append_column("ranges", ranges)
        yield from out.filter(pa.array(some)).combine_chunks().to_batches()
    return by_group(distinct.select(*SEGMENT_COLUMNS), ["key"], ["sub"], run, f"key bigint, sub bigint, ranges {RANGES}",
                    rows=6_000)


def split_segments(large: DataFrame, span: int, width: int) -> DataFrame:
    """The segments of large keys, split by ranges of ``width`` offsets to the
    anchor: (key, sub) of the parent, ``start`` in it, and the part, whose key
    hashes the bytes that every window of the range holds."""
    def run(batches: Iterator[pa.RecordBatch]):
        import xxhash
        digest = xxhash.xxh3_64_intdigest
        signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x                # noqa: E731
        for b in batches:
            out = []
            for key, sub, n, rel, windows, text in zip(*(b.column(c).to_pylist() for c in SEGMENT_COLUMNS)):
                for q in range(max(0, rel - windows + 1) // width, rel // width + 1):
                    lo, hi = max(0, rel - (q + 1) * width + 1), min(windows - 1, rel - q * width)
                    core = text[max(0, rel - q * width):rel - (q + 1) * width + 1 + span]
                    part = text[lo:hi + span]
                    out.append((key, sub, lo, signed(digest(core, seed=(key + q * 2654435761) % (1 << 64))),
                                signed(digest(part)), n, rel - lo, hi - lo + 1, part))
            types = (pa.int64(), pa.int64(), pa.int32(), *SEGMENT_TYPES)
            yield record_batch(["up_key", "up_sub", "start", *SEGMENT_COLUMNS],
                               [pa.array([o[j] for o in out], t) for j, t in enumerate(types)])
    return large.select(*SEGMENT_COLUMNS).mapInArrow(run, f"up_key bigint, up_sub bigint, start int, {SEGMENT}")


def judge_all(distinct: DataFrame, span: int, width: int, limit: int) -> DataFrame:
    """judge_segments for keys of at most ``limit`` segments; larger keys are
    split by offset, a quarter of the range at a time, and judged part by part.
    At single offsets all windows of a key are equal and one row."""
    sizes = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("__k"))
    large_keys = store(sizes.filter(F.col("__k") > limit).select("key"), "large-anchors")
    if width == 1 or large_keys.isEmpty():
        return judge_segments(distinct, span)
    width = -(-width // 4)
    parts = store(split_segments(distinct.join(large_keys, "key", "left_semi"), span, width), "anchor-parts")
    counted = parts.groupBy("key").agg(F.sum("n").alias("__n")).filter("__n >= 2").select("key")
    below = store(parts.join(counted, "key", "left_semi").groupBy("key", "sub", "rel", "windows", "bytes")
                  .agg(F.sum("n").alias("n")).select(*SEGMENT_COLUMNS), "part-segments")
    judged = judge_all(below, span, width, limit).withColumnRenamed("ranges", "__r")
    up = parts.select("up_key", "up_sub", "start", "key", "sub").join(judged, ["key", "sub"]).select(
        F.col("up_key").alias("key"), F.col("up_sub").alias("sub"),
        F.transform("__r", lambda r: F.struct((r["from"] + F.col("start")).cast("int").alias("from"),
                                              (r["to"] + F.col("start")).cast("int").alias("to"))).alias("ranges"))
    up = up.groupBy("key", "sub").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))       # parts of one segment
    return judge_segments(distinct.join(large_keys, "key", "left_anti"), span).unionByName(up)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM,
                   group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) per row; kept is the remaining bytes."""
    rows = packed_rows(docs, id_col, text_col)
    found = store(occurrences(rows, span, gram), "occurrences")
    distinct = store(found.groupBy("anchor", "skey").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc")),
                     "distinct-segments")
    texts = store(representatives(rows, distinct, span, gram), "representatives")
    judged = judge_all(texts, span, span - gram + 1, group_limit).select(
        F.col("key").alias("anchor"), F.col("sub").alias("skey"), "ranges")
    cover = found.join(judged, ["anchor", "skey"]).groupBy("doc").agg(
        F.collect_set(F.struct("at", "skey", "windows", "ranges")).alias("cover"))    # bounded by the document's length
    joined = squeezed(rows).join(cover, "doc", "left").select("id", "packed", "cover")

    def run(batches: Iterator[pa.RecordBatch]):
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                texts = [b"" if p is None else unpack(p) for p in part.column("packed").to_pylist()]
                off = np.cumsum([0] + [len(t) for t in texts])
                text = b"".join(texts)
                gone = covered(text, off, part.column("cover"), span)
                total = np.append(0, np.cumsum(gone))
                first = gone.copy()
                first[1:] &= ~gone[:-1] | np.isin(np.arange(1, len(gone)), off)
                spans = np.append(0, np.cumsum(first))
                x = np.frombuffer(text, np.uint8)
                kept = [t if total[z] == total[a] else x[a:z][~gone[a:z]].tobytes()
                        for t, a, z in zip(texts, off[:-1], off[1:])]
                yield record_batch(["id", "n_bytes", "n_removed", "n_spans", "kept"], [
                    part.column("id"), np.diff(off), np.diff(total[off]), np.diff(spans[off]), pa.array(kept, pa.binary())])
    return joined.mapInArrow(run, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def covered(text: bytes, off: np.ndarray, cover: pa.Array, span: int) -> np.ndarray:
    """Mask of the bytes that the texts' covers remove; a listed segment counts
    only where the text holds it."""
    import xxhash
    digest = xxhash.xxh3_64_intdigest
    size = np.diff(off)
    rows = np.repeat(np.arange(len(cover)), np.nan_to_num(pc.list_value_length(cover).to_numpy(zero_copy_only=False))
                     .astype(np.int64))
    flat = cover.flatten()
    at, windows = flat.field("at").to_numpy().astype(np.int64), flat.field("windows").to_numpy().astype(np.int64)
    start = off[rows] + at
    end = start + windows - 1 + span
    skey = flat.field("skey").to_numpy().view(np.uint64).tolist()
    real = np.fromiter((digest(text[a:z]) == k for a, z, k in zip(start.tolist(), end.tolist(), skey)), bool, len(skey))
    real &= at + windows - 1 + span <= size[rows]
    ranges = flat.field("ranges")
    which = np.repeat(np.arange(len(flat)), np.diff(ranges.offsets.to_numpy()))
    inner = ranges.values.slice(ranges.offsets[0].as_py(), len(which)) if len(flat) else ranges.values
    ok = real[which]
    edge = np.zeros(len(text) + 1, np.int64)
    if ok.any():
        np.add.at(edge, start[which][ok] + inner.field("from").to_numpy()[ok], 1)
        np.add.at(edge, start[which][ok] + inner.field("to").to_numpy()[ok], -1)
    return np.cumsum(edge[:-1]) > 0
