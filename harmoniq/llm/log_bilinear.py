"""Language-model scoring with a log-bilinear model trained in numpy.

Counts of every word over all training documents give the base score.  The
model has a core of SYMBOLS symbols: the most frequent words, classes of the
other words (by their last two bytes) and the end of a text.  The core's
log-bilinear model (context vector times a matrix, dotted with the output
vector, plus a bias) is trained by noise-contrastive estimation on the pair
counts of all training documents; the noise expectation is taken exactly
instead of by samples, so training is deterministic.

Every other distinct training word has vectors of its own, as context and as
output.  They are learned by the same estimation from the word's sparse counts
(symbols before it, symbols after it), gathered over all training documents and
fitted word by word in the partitions they are shuffled to.
P(w | c) = P(symbol of w | c) P(w | its class, symbol of c): the first factor
uses the own vector of c, the second that of w, and both are normalised
exactly.  Two words outside the core thus meet through one's class; counts of
pairs of such words are not gathered.

The corpus is stored once as blocks (a bounded run of documents with its own
vocabulary; words are numbered by frequency and the token numbers compressed).
A word's counts are summed over blocks (over groups of them first, if they are
many), its vectors are fitted once and stored once, with the list of its blocks.
A word that was seen once has the vectors of its class and its two neighbours:
they are computed beforehand for every class and symbol, and only the
neighbours are kept.  The KNOWN most frequent words are broadcast with their
vectors (a bounded table); the others return to their blocks, rounded to 8 bits
before they are normalised, so no vocabulary is ever broadcast.  Which words are
frequent is decided from each block's NAMED most frequent ones; all counts that
enter a score are exact.  The driver sees the core, its pair counts, the known
words and one normaliser per class and symbol.

Results: null and empty texts have one token, the end; words are separated by ASCII
white space, A-Z lower-cased; words of equal frequency are ranked by hash;
with no training documents every symbol is equally likely; repeated rows
are scored alike and count each time; an empty table gives an empty table; other columns are
ignored.  Texts are scored whole whatever their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import as_bytes, bounded, by_group, group_starts, record_batch, store

SYMBOLS, CLASSES = 512, 64
TOP = SYMBOLS - CLASSES - 1
END = SYMBOLS - 1                       # the end of a text, and what stands before its first word
DIM = 24
NOISE_RATIO = 25.0
STEPS, RATE = 100, 0.05
PRIOR = 100.0
WORD_PRIOR = 5.0
FIT_ROUNDS, FIT_SCALES = 1, (0.6, 0.25)
FIT_WORDS = 2048
SCORE_TOKENS = 1 << 16
RUN_TOKENS = 1 << 20                    # tokens that are scored at a time
BLOCK_BYTES, PIECE_BYTES = 32 << 20, 1 << 20
NAMED, KNOWN = 1 << 17, 1 << 16         # frequent words that a block names; those whose vectors are broadcast
GROUP = 512                             # blocks whose counts of a word are summed in one group
BLOCK = ("block bigint, ids array<bigint>, held array<boolean>, sizes binary, tokens binary, words binary, "
         "classes binary, train binary")


# ---- blocks ------------------------------------------------------------------------------
def encode(texts: list[bytes], held: list[bool]) -> tuple[np.ndarray, ...]:
    """sizes, tokens (local word numbers), word hashes, classes, training counts;
    words are numbered by falling frequency, then by hash."""
    import xxhash
    ids: dict[bytes, int] = {}
    put = ids.setdefault
    sizes, pieces, piece, size = np.zeros(len(texts), np.int32), [], [], 0
    for k, t in enumerate(texts):
        words = t.lower().split()
        sizes[k] = len(words)
        piece += words
        size += len(t)
        if size >= PIECE_BYTES or k + 1 == len(texts):
            pieces.append(np.fromiter((put(w, len(ids)) for w in piece), np.int32, len(piece)))
            piece, size = [], 0
    tokens = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
    del pieces
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids)).view(np.int64)
    classes = np.fromiter((zlib.crc32(w[-2:]) % CLASSES for w in ids), np.uint8, len(ids))
    order = np.lexsort((words, -np.bincount(tokens, minlength=len(ids))))
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids), dtype=np.int32)
    tokens = place[tokens] if len(ids) else tokens
    learn = np.repeat(~np.array(held, bool), sizes)
    train = np.bincount(tokens[learn], minlength=len(ids)).astype(np.int32)
    return sizes, tokens, words[order], classes[order], train


def packed(tokens: np.ndarray) -> bytes:
    return pa.Codec("zstd").compress(tokens.tobytes(), asbytes=True)


def unpacked(r: dict) -> np.ndarray:
    n = int(np.frombuffer(r["sizes"], np.int32).sum(dtype=np.int64))
    return np.frombuffer(pa.Codec("zstd").decompress(r["tokens"], n * 4, asbytes=True), np.int32) if n else np.zeros(0, np.int32)


def build_blocks(docs: DataFrame, held_out: Column, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        import xxhash
        for b in bounded(batches, "text", block_bytes):
            texts, held = as_bytes(b.column("text")), b.column("held").to_pylist()
            parts = encode(texts, held)
            ids = b.column("id").to_pylist()
            name = np.array([xxhash.xxh3_64_intdigest(parts[1].tobytes() + repr(ids).encode())], np.uint64).view(np.int64)
            yield record_batch([c.split()[0] for c in BLOCK.split(", ")], [
                name, pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_()))]
                + [pa.array([packed(x) if k == 1 else x.tobytes()], pa.binary()) for k, x in enumerate(parts)])
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                      F.col(text_col).cast("string").alias("text"))
    return store(src.mapInArrow(run, BLOCK), "lm-blocks")


def frequent_words(blocks: DataFrame) -> np.ndarray:
    """Hashes of the most frequent training words, KNOWN at most, by rank."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                words, n = np.frombuffer(r["words"], np.int64), np.frombuffer(r["train"], np.int32)
                some = np.lexsort((words, -n))[:NAMED]
                some = some[n[some] > 0]
                yield record_batch(["word", "n"], [words[some], n[some]])
    named = blocks.select("words", "train").mapInArrow(run, "word bigint, n int")
    ranked = named.groupBy("word").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "word").limit(KNOWN)
    return np.array([r["word"] for r in ranked.collect()], np.int64)


# ---- symbols and pairs --------------------------------------------------------------------------
def symbols_of(words: np.ndarray, classes: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Symbol of each word: its rank among the frequent ones (``top``: their
    hashes by rank), else TOP + class."""
    out = TOP + classes.astype(np.int64)
    if len(top):
        order = np.argsort(top)
        at = np.minimum(np.searchsorted(top[order], words), len(top) - 1)
        hit = top[order][at] == words
        out[hit] = order[at[hit]]
    return out


def with_ends(sizes: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, symbol) of every token, the end of each text included."""
    ends = np.cumsum(sizes + 1) - 1
    cur = np.full(int((sizes + 1).sum()), END, symbols.dtype)
    body = np.ones(len(cur), bool)
    body[ends] = False
    cur[body] = symbols
    prev = np.empty_like(cur)
    prev[1:] = cur[:-1]
    prev[:1] = END                      # a text begins after an end
    return prev, cur


def runs_of(sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, end, first token, end) of runs of whole texts of about
    RUN_TOKENS tokens; a longer text is a run of its own."""
    first, a = np.append(0, np.cumsum(sizes)), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(first, first[a] + RUN_TOKENS, "right")) - 1)
        yield a, b, int(first[a]), int(first[b])
        a = b


def pair_counts(blocks: DataFrame, top: np.ndarray) -> np.ndarray:
    """SYMBOLS x SYMBOLS counts of (context, symbol) over all training
    documents: a sum per task, then per context."""
    shared = blocks.sparkSession.sparkContext.broadcast(top)

    def count(batches):
        total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                sizes, held = np.frombuffer(r["sizes"], np.int32).astype(np.int64), np.array(r["held"], bool)
                sym = symbols_of(np.frombuffer(r["words"], np.int64), np.frombuffer(r["classes"], np.uint8), shared.value)
                tokens = unpacked(r)
                for a, b, start, end in runs_of(sizes):
                    prev, cur = with_ends(sizes[a:b], sym[tokens[start:end]] if len(sym) else np.zeros(0, np.int64))
                    learn = np.repeat(~held[a:b], sizes[a:b] + 1)
                    total += np.bincount(prev[learn] * SYMBOLS + cur[learn], minlength=SYMBOLS * SYMBOLS)
        rows = total.reshape(SYMBOLS, SYMBOLS)
        some = np.flatnonzero(rows.any(axis=1))
        yield record_batch(["context", "counts"], [some.astype(np.int32), pa.array([rows[c].tobytes() for c in some], pa.binary())])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for c, x in zip(b.column("context").to_pylist(), b.column("counts").to_pylist()):
                total[c] = total.get(c, 0) + np.frombuffer(x, np.int64)
        yield record_batch(["context", "counts"], [pa.array(list(total), pa.int32()),
                                                   pa.array([v.tobytes() for v in total.values()], pa.binary())])
    parts = blocks.select("held", "sizes", "tokens", "words", "classes").mapInArrow(count, "context int, counts binary")
    out = np.zeros((SYMBOLS, SYMBOLS))
    for r in parts.repartition("context").mapInArrow(add, "context int, counts binary").collect():
        out[r["context"]] = np.frombuffer(r["counts"], np.int64)
    return out


# ---- the model ---------------------------------------------------------------------------------
def train(pairs: np.ndarray, dim: int = DIM, ratio: float = NOISE_RATIO, steps: int = STEPS, rate: float = RATE,
          prior: float = PRIOR) -> dict:
    """Noise-contrastive estimation of s(c, w) = (r_c M) . q_w + b_w against the
    symbol frequencies: ascent (Adam) on
    sum n(c, w) ln sig(d) + ratio * sum n(c) p(w) ln (1 - sig(d)), d = s - ln(ratio p(w)).
    Each context's counts hold ``prior`` draws of the symbol frequencies besides
    its own, so rare contexts stay near them."""
    size = len(pairs)
    rng = np.random.default_rng(0)
    freq = pairs.sum(axis=0) + 0.5
    noise = freq / freq.sum()
    pairs = pairs + prior * noise
    of_context = pairs.sum(axis=1, keepdims=True)
    scale = 1.0 / max(pairs.sum(), 1.0)
    par = {"r": rng.normal(0, 0.1, (size, dim)), "m": np.eye(dim) + rng.normal(0, 0.01, (dim, dim)),
           "q": rng.normal(0, 0.1, (size, dim)), "b": np.log(noise)}
    mean, square = {k: np.zeros_like(v) for k, v in par.items()}, {k: np.zeros_like(v) for k, v in par.items()}
    shift, drawn = np.log(ratio * noise), ratio * noise
    for t in range(1, steps + 1):
        hidden = par["r"] @ par["m"]
        sig = 1 / (1 + np.exp(-(hidden @ par["q"].T + par["b"] - shift)))
        d = (pairs * (1 - sig) - of_context * drawn * sig) * scale
        back = d @ par["q"]
        grad = {"r": back @ par["m"].T, "m": par["r"].T @ back, "q": d.T @ hidden, "b": d.sum(axis=0)}
        for k in par:
            mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
            square[k] = 0.99 * square[k] + 0.01 * grad[k] ** 2
            par[k] += rate * (mean[k] / (1 - 0.9 ** t)) / (np.sqrt(square[k] / (1 - 0.99 ** t)) + 1e-9)
    return par


def log_table(par: dict) -> np.ndarray:
    """Normalised log10 P(symbol | context) for all contexts at once."""
    s = (par["r"] @ par["m"]) @ par["q"].T + par["b"]
    s -= s.max(axis=1, keepdims=True)
    return (s - np.log(np.exp(s).sum(axis=1, keepdims=True))) / np.log(10)


# ---- vectors of the words outside the core ---------------------------------------------------------
def binary_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """values[bounds[i]:bounds[i + 1]] as the i-th binary."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def from_binary(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, number of values per row)."""
    arr = pa.concat_arrays(column.chunks).cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return data.view(kind), np.diff(off) // np.dtype(kind).itemsize


CONTEXT = "word bigint, class int, block bigint, place int, n int, slots binary, counts binary"


def word_contexts(blocks: DataFrame, known: np.ndarray) -> DataFrame:
    """Sparse counts of each word outside the core in each block: slot s for
    symbol s before it, slot SYMBOLS + s for symbol s after it.  ``place`` is its
    number in the block, -1 for the known words, which need not come back."""
    shared = blocks.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        top, common = shared.value[:TOP], np.sort(shared.value)
        for b in batches:
            for r in b.to_pylist():
                sizes, held = np.frombuffer(r["sizes"], np.int32).astype(np.int64), np.array(r["held"], bool)
                own, classes = np.frombuffer(r["words"], np.int64), np.frombuffer(r["classes"], np.uint8)
                if not len(own):
                    continue
                tokens = unpacked(r)
                sym = symbols_of(own, classes, top)
                prev, cur = with_ends(sizes, sym.astype(np.int16)[tokens])
                body = np.ones(len(cur), bool)
                body[np.cumsum(sizes + 1) - 1] = False
                place = np.full(len(cur), -1, np.int32)
                place[body] = tokens
                at = np.flatnonzero(np.repeat(~held, sizes + 1) & body & (cur >= TOP))
                place = place[at].astype(np.int32 if len(own) < 2 ** 31 // (2 * SYMBOLS) else np.int64)
                key = np.concatenate([place * (2 * SYMBOLS) + prev[at], place * (2 * SYMBOLS) + SYMBOLS + cur[at + 1]])
                del prev, cur, body, at, place
                key.sort()
                n = np.flatnonzero(np.append(key[1:] != key[:-1], True)) if len(key) else np.zeros(0, np.int64)
                key, n = key[n], np.diff(np.append(-1, n))
                train = np.frombuffer(r["train"], np.int32)
                back = ~np.isin(own, common)
                rare = np.flatnonzero((sym >= TOP) & (back | (train > 0)))
                bounds = np.append(np.searchsorted(key, (rare * 2 * SYMBOLS).astype(key.dtype)), len(key))
                yield record_batch([c.split()[0] for c in CONTEXT.split(", ")], [
                    own[rare], classes[rare].astype(np.int32), np.full(len(rare), r["block"]),
                    np.where(back[rare], rare, -1).astype(np.int32), train[rare],
                    binary_rows((key % (2 * SYMBOLS)).astype(np.uint16), bounds), binary_rows(n.astype(np.int32), bounds)])
    return blocks.mapInArrow(run, CONTEXT)


def side(basis: np.ndarray, offset: np.ndarray, noise: np.ndarray, start: np.ndarray) -> dict:
    """What the words of every class share in fit(): the symbols' vectors, and
    per class the scores, noise and model shares of the symbols without an own
    vector, and the inverse information of the estimate there."""
    keep = 1 - 1 / (1 + NOISE_RATIO * np.exp(-offset))
    info = np.einsum("ks,si,sj->kij", start * keep, basis, basis)
    dim = basis.shape[1]
    info += np.eye(dim) * (0.01 * np.trace(info, axis1=1, axis2=2) / dim + 1e-6)[:, None, None]
    return {k: np.asarray(v, np.float32) for k, v in (
        ("basis", basis), ("offset", offset), ("noise", noise), ("start", start), ("inverse", np.linalg.inv(info)))}


def sides(par: dict, pairs: np.ndarray) -> dict:
    hidden, table = par["r"] @ par["m"], log_table(par) * np.log(10)
    before = pairs[:, TOP:END].T + pairs.sum(axis=1) / max(pairs.sum(), 1.0) + 1e-6
    before /= before.sum(axis=1, keepdims=True)          # symbols before a class
    noise = pairs.sum(axis=0) + 0.5
    noise /= noise.sum()
    raw = hidden[TOP:END] @ par["q"].T + par["b"]
    return {"out": side(np.hstack([hidden, np.ones((SYMBOLS, 1))]), np.zeros_like(before), before, before),
            "context": side(par["q"], raw - np.log(noise), np.broadcast_to(noise, raw.shape), np.exp(table[TOP:END]))}


def fit(counts: np.ndarray, classes: np.ndarray, s: dict, prior: float = WORD_PRIOR) -> np.ndarray:
    """Own vectors x (words x dim) from counts (words x symbols): ascent on
    sum n ln sig(d) + ratio * sum e ln (1 - sig(d)), d = offset + x . basis - ln(ratio),
    where e are the noise's counts and n holds ``prior`` draws of the class
    besides the word's own.  Steps are along the inverse information of the
    class, as long as the objective rises."""
    total = (counts.sum(axis=1, keepdims=True) + prior).astype(np.float32)
    n = counts.astype(np.float32) + np.float32(prior) * s["start"][classes]
    e = total * s["noise"][classes] * np.float32(NOISE_RATIO)
    offset, inverse = s["offset"][classes], s["inverse"][classes]

    def log_ratio(x):
        return np.clip(offset + x @ s["basis"].T, -30, 30) - np.float32(np.log(NOISE_RATIO))

    def value(d, t):
        return (n * d - (n + e) * np.log1p(t)).sum(axis=1, dtype=np.float64)
    x = np.zeros((len(counts), s["basis"].shape[1]), np.float32)
    d = log_ratio(x)
    t = np.exp(d)
    best = value(d, t)
    for _ in range(FIT_ROUNDS):
        sig = t / (1 + t)
        step = np.einsum("wi,wij->wj", (n * (1 - sig) - e * sig) @ s["basis"], inverse) / total
        here = x.copy()
        for scale in FIT_SCALES:
            tried = here + np.float32(scale) * step
            d = log_ratio(tried)
            r = np.exp(d)
            v = value(d, r)
            up = v > best
            x[up], best[up], t[up] = tried[up], v[up], r[up]
    return x


def to_bytes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale, rounded values) of each row."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    return scale, np.rint(x / np.maximum(scale, 1e-30)[:, None]).astype(np.int8)


VECTORS = np.dtype([("out_scale", "<f4"), ("context_scale", "<f4"), ("log_z", "<f4"), ("out", "i1", DIM + 1),
                    ("context", "i1", DIM)])


def own_vectors(counts: np.ndarray, classes: np.ndarray, core: dict) -> np.ndarray:
    """VECTORS of each word; log_z normalises the word as context."""
    made = np.zeros(len(counts), VECTORS)
    for name, part in (("out", counts[:, :SYMBOLS]), ("context", counts[:, SYMBOLS:])):
        made[f"{name}_scale"], made[name] = to_bytes(fit(part, classes, core[name]))
    made["log_z"] = log_sum(hidden_of(made, classes, core) @ core["q"].T + core["b"])
    return made


def log_sum(u: np.ndarray) -> np.ndarray:
    high = u.max(axis=1, keepdims=True)
    return (high + np.log(np.exp(u - high).sum(axis=1, keepdims=True)))[:, 0]


def hidden_of(v: np.ndarray, classes: np.ndarray, core: dict) -> np.ndarray:
    return core["hidden"][TOP + classes] + v["context"] * v["context_scale"][:, None]


def lists_of(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


class Words:
    """The word groups of a sorted table: counts in ``n`` at ``slot`` of word
    ``of``; the blocks that want it back and its places there."""

    def __init__(self, table: pa.Table, key: tuple | list = ("word",)):
        self.starts = group_starts(table, key)
        rows = np.diff(np.append(self.starts, table.num_rows))
        group = np.repeat(np.arange(len(self.starts)), rows)
        self.word = table["word"].to_numpy()[self.starts]
        self.classes = table["class"].to_numpy()[self.starts].astype(np.int64)
        self.c = np.add.reduceat(table["n"].to_numpy().astype(np.int64), self.starts)
        self.slot, size = from_binary(table["slots"], np.uint16)
        self.n, _ = from_binary(table["counts"], np.int32)
        self.of = np.repeat(group, size)
        if "blocks" in table.column_names:
            blocks, places = (table[k].combine_chunks() for k in ("blocks", "places"))
            sizes = np.diff(blocks.offsets.to_numpy())
            self.blocks, self.places = blocks.flatten().to_numpy(), places.flatten().to_numpy()
            of = np.repeat(group, sizes)
        else:
            back = table["place"].to_numpy() >= 0
            self.blocks, self.places, of = table["block"].to_numpy()[back], table["place"].to_numpy()[back], group[back]
        self.wanted = np.bincount(of, minlength=len(self.starts))


SUMMED = "word bigint, class int, n bigint, slots binary, counts binary, blocks array<bigint>, places array<int>"


def summed(contexts: DataFrame, groups: int) -> DataFrame:
    """One row per (word, group of blocks)."""
    def run(table: pa.Table):
        w = Words(table, ["word", "salt"])
        key, at = np.unique(w.of * 2 * SYMBOLS + w.slot, return_inverse=True)
        n = np.bincount(at, w.n, len(key)).astype(np.int32)
        bounds = np.searchsorted(key, np.arange(len(w.starts) + 1) * 2 * SYMBOLS)
        yield record_batch([c.split()[0] for c in SUMMED.split(", ")], [
            w.word, w.classes.astype(np.int32), w.c, binary_rows((key % (2 * SYMBOLS)).astype(np.uint16), bounds),
            binary_rows(n, bounds), lists_of(w.blocks, w.wanted, pa.int64()), lists_of(w.places, w.wanted, pa.int32())])
    salted = contexts.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(groups)))
    return by_group(salted, ["word", "salt"], [], run, SUMMED, 8000)


FITTED = ("word bigint, class int, c bigint, code int, vectors binary, blocks array<bigint>, places array<int>")


def word_vectors(contexts: DataFrame, core: dict, n_blocks: int) -> DataFrame:
    """One stored row per training word outside the core: its count and its
    vectors, or for a word seen once the code of its neighbours (before *
    SYMBOLS + after), and where it is wanted.  A word's group has a row per
    block, or per GROUP blocks if there are more of them."""
    shared = contexts.sparkSession.sparkContext.broadcast(core)
    if n_blocks > GROUP:
        contexts = summed(contexts, -(-n_blocks // GROUP))

    def run(table: pa.Table):
        w = Words(table)
        made = np.zeros(len(w.starts), VECTORS)
        fitted = np.flatnonzero(w.c > 1)
        local = np.full(len(w.starts), -1)
        local[fitted] = np.arange(len(fitted))
        of = local[w.of]
        code = np.zeros(len(w.starts), np.int32)
        once = w.c[w.of] == 1
        before = once & (w.slot < SYMBOLS)
        after = once & ~before
        code[w.of[before]] += w.slot[before].astype(np.int32) * SYMBOLS
        code[w.of[after]] += w.slot[after].astype(np.int32) - SYMBOLS
        order = np.argsort(of, kind="stable")
        edge = np.searchsorted(of[order], np.arange(0, len(fitted) + FIT_WORDS, FIT_WORDS))
        for k, at in enumerate(range(0, len(fitted), FIT_WORDS)):
            to, some = min(at + FIT_WORDS, len(fitted)), order[edge[k]:edge[k + 1]]
            counts = np.bincount((of[some] - at) * 2 * SYMBOLS + w.slot[some], w.n[some], (to - at) * 2 * SYMBOLS)
            made[fitted[at:to]] = own_vectors(counts.reshape(to - at, -1), w.classes[fitted[at:to]], shared.value)
        rows = np.flatnonzero(w.c > 0)
        stays = np.repeat(w.c > 0, w.wanted)
        bounds = np.append(0, np.cumsum(w.c[rows] > 1))
        yield record_batch([c.split()[0] for c in FITTED.split(", ")], [
            w.word[rows], w.classes[rows].astype(np.int32), w.c[rows], code[rows],
            binary_rows(made[rows][w.c[rows] > 1], bounds), lists_of(w.blocks[stays], w.wanted[rows], pa.int64()),
            lists_of(w.places[stays], w.wanted[rows], pa.int32())])
    return store(by_group(contexts, ["word"], [], run, FITTED, 8000), "lm-vectors")


def single_vectors(core: dict) -> np.ndarray:
    """VECTORS of a word seen once, by class * SYMBOLS + symbol: the output part
    for that symbol before it, the context part for that symbol after it."""
    out = []
    for at in range(0, CLASSES * SYMBOLS, FIT_WORDS):
        row = np.arange(at, at + FIT_WORDS)
        counts = np.zeros((FIT_WORDS, 2 * SYMBOLS))
        counts[np.arange(FIT_WORDS), row % SYMBOLS] = 1
        counts[np.arange(FIT_WORDS), SYMBOLS + row % SYMBOLS] = 1
        out.append(own_vectors(counts, row // SYMBOLS, core))
    return np.concatenate(out)


def seen_once(singles: np.ndarray, classes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """VECTORS from the codes of words seen once."""
    out = singles[classes * SYMBOLS + code // SYMBOLS].copy()
    after = singles[classes * SYMBOLS + code % SYMBOLS]
    for k in ("context", "context_scale", "log_z"):
        out[k] = after[k]
    return out


def normalisers(vectors: DataFrame, core: dict, class_size: np.ndarray, singles: np.ndarray) -> np.ndarray:
    """ln Z (CLASSES x SYMBOLS): a class's words and one unseen word, by the
    symbol before them."""
    shared = vectors.sparkSession.sparkContext.broadcast((core["before"], class_size))

    def run(batches):
        before, sizes = shared.value
        total = np.zeros((CLASSES, SYMBOLS))
        for b in batches:
            table = pa.Table.from_batches([b])
            if not table.num_rows:
                continue
            v, k = from_binary(table["vectors"], VECTORS)[0], table["class"].to_numpy().astype(np.int64)
            share = (table["c"].to_numpy() + 1) / sizes[k]
            for at in range(0, len(k), FIT_WORDS):
                some = slice(at, at + FIT_WORDS)
                u = (v["out"][some] * v["out_scale"][some, None]) @ before.T
                order = np.argsort(k[some], kind="stable")
                kinds, first = np.unique(k[some][order], return_index=True)
                total[kinds] += np.add.reduceat((np.exp(u) * share[some, None])[order], first)
        yield from sums({k: row for k, row in enumerate(total) if row.any()})

    def sums(total):
        yield record_batch(["class", "z"], [pa.array(list(total), pa.int32()),
                                            pa.array([x.tobytes() for x in total.values()], pa.binary())])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("class").to_pylist(), b.column("z").to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(x)
        yield from sums(total)
    z = np.repeat(1 / class_size[:, None], SYMBOLS, axis=1)
    parts = vectors.filter("c > 1").select("class", "c", "vectors").mapInArrow(run, "class int, z binary")
    for r in parts.repartition("class").mapInArrow(add, "class int, z binary").collect():
        z[r["class"]] += np.frombuffer(r["z"])
    # words seen once: one count per class and symbol before them
    once = np.zeros((CLASSES, SYMBOLS))
    for r in vectors.filter("c = 1").groupBy("class", F.floor(F.col("code") / SYMBOLS).alias("s")).count().collect():
        once[r["class"], r["s"]] = r["count"]
    out = (singles["out"] * singles["out_scale"][:, None]).reshape(CLASSES, SYMBOLS, DIM + 1)
    for k in range(CLASSES):
        z[k] += (2 / class_size[k]) * (once[k] @ np.exp(out[k] @ core["before"].T))
    return np.log(z)


# ---- the operator ----------------------------------------------------------------------------------
def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    blocks = build_blocks(docs, held_out, id_col, text_col, block_bytes)
    known = frequent_words(blocks)
    stats = blocks.agg(F.count(F.lit(1)).alias("blocks"),
                       F.sum(F.size(F.filter("held", lambda h: ~h))).alias("texts")).first()
    texts = stats["texts"] or 0
    pairs = pair_counts(blocks, known[:TOP])
    par = train(pairs)
    core = {"hidden": par["r"] @ par["m"], "q": par["q"], "b": par["b"]}
    core = {k: v.astype(np.float32) for k, v in core.items()} | sides(par, pairs)
    core["before"] = core["out"]["basis"]
    vectors = word_vectors(word_contexts(blocks, known), core, stats["blocks"])
    rest_c, rest_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in vectors.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        rest_c[r["class"]], rest_v[r["class"]] = r["c"], r["v"]
    top_c = pairs.sum(axis=0)[:len(known[:TOP])].astype(np.int64)       # a core word is a symbol of its own
    n_tokens = int(rest_c.sum() + top_c.sum() + texts)
    n_words = int(rest_v.sum()) + len(top_c) + (texts > 0)
    singles = single_vectors(core)
    common = vectors.sparkSession.createDataFrame(pa.table({"word": known[TOP:]})) if len(known) > TOP else None
    rows = vectors.join(F.broadcast(common), "word").select("word", "c", "code", "class", "vectors").collect() if common else []
    model = {"top": known[:TOP], "top_c": top_c, "core": core, "table": log_table(par), "singles": singles,
             "class_log": np.log10(rest_c + rest_v + 1), "common": known_words(rows, singles),
             "log_z": normalisers(vectors, core, rest_c + rest_v + 1, singles),
             "texts": int(texts), "n": n_tokens, "base_log": float(np.log10(n_tokens + n_words + 1))}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    back = vectors.select("c", "code", "vectors", F.explode(F.arrays_zip("blocks", "places")).alias("at")).select(
        F.col("at.blocks").alias("block"), F.col("at.places").alias("place"), "c", "code", "vectors")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [score_block(r, right, shared.value) for r in left.to_pylist()]
        return pa.Table.from_batches(out, RESULT)
    return (blocks.drop("train").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        run, "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double"))


RESULT = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def known_words(rows: list, singles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, VECTORS) of the known words outside the core, by hash."""
    rows = sorted(rows, key=lambda r: r["word"])
    v = np.zeros(len(rows), VECTORS)
    for k, r in enumerate(rows):
        v[k] = np.frombuffer(r["vectors"], VECTORS)[0] if r["c"] > 1 else \
            seen_once(singles, np.array([r["class"]]), np.array([r["code"]]))[0]
    return np.array([r["word"] for r in rows], np.int64), np.array([r["c"] for r in rows], np.int64), v


def own_terms(model: np.ndarray, prev: np.ndarray, cur: np.ndarray, place: np.ndarray, learned: np.ndarray,
              v: np.ndarray, classes: np.ndarray, m: dict) -> None:
    """Put what the words' own vectors say into the tokens' log10 probabilities;
    ``place`` is a token's local word, -1 for an end."""
    core = m["core"]
    inside = np.append(learned, False)                   # of an end: the last one
    rare = np.flatnonzero((place >= 0) & (cur >= TOP))
    for at in range(0, len(rare), SCORE_TOKENS):
        t = rare[at:at + SCORE_TOKENS]
        w = place[t]
        u = np.einsum("ij,ij->i", core["before"][prev[t]], v["out"][w] * v["out_scale"][w, None])
        model[t] += (u - m["log_z"][classes[w], prev[t]]) / np.log(10)
    after = np.flatnonzero(inside[place[:-1]]) + 1
    for at in range(0, len(after), SCORE_TOKENS):
        t = after[at:at + SCORE_TOKENS]
        c = place[t - 1]
        u = np.einsum("ij,ij->i", hidden_of(v[c], classes[c], core), core["q"][cur[t]]) + core["b"][cur[t]]
        model[t] += (u - v["log_z"][c]) / np.log(10) - m["table"][prev[t], cur[t]]


def score_block(r: dict, back: pa.Table, m: dict) -> pa.RecordBatch:
    sizes = np.frombuffer(r["sizes"], np.int32).astype(np.int64)
    own = np.frombuffer(r["words"], np.int64)
    classes = np.frombuffer(r["classes"], np.uint8).astype(np.int64)
    seen, v = np.zeros(len(own), np.int64), np.zeros(len(own), VECTORS)
    sym = symbols_of(own, classes, m["top"])
    seen[sym < TOP] = m["top_c"][sym[sym < TOP]]
    word, c, vectors = m["common"]
    if len(word) and len(own):
        at = np.minimum(np.searchsorted(word, own), len(word) - 1)
        hit = (word[at] == own) & (sym >= TOP)
        seen[hit], v[hit] = c[at[hit]], vectors[at[hit]]
    if back.num_rows:
        place, c, code = (back[k].to_numpy() for k in ("place", "c", "code"))
        seen[place] = c
        fitted, once = place[c > 1], place[c == 1]
        v[fitted] = from_binary(back["vectors"], VECTORS)[0]
        v[once] = seen_once(m["singles"], classes[once], code[c == 1])
    learned = (sym >= TOP) & (seen > 0)
    log_c = np.log10(seen + 1.0)
    rare = np.where(sym < TOP, 0.0, log_c - m["class_log"][classes]) if len(own) else np.zeros(0)
    tokens = unpacked(r)
    kept = [score_run(sizes[a:b], tokens[start:end], sym, seen, learned, v, classes, log_c, rare, m)
            for a, b, start, end in runs_of(sizes)]
    known, base, model = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.zeros(0),) * 3
    n = sizes + 1
    return pa.RecordBatch.from_arrays([
        pa.array(x, f.type) for x, f in zip((r["ids"], r["held"], n, known.astype(np.int64), np.full(len(n), m["n"]),
                                             base - n * m["base_log"], model), RESULT, strict=True)], schema=RESULT)


def score_run(sizes, tokens, sym, seen, learned, v, classes, log_c, rare, m) -> tuple[np.ndarray, ...]:
    """(known tokens, base sum, log10 probability) of each text."""
    prev, cur = with_ends(sizes, sym[tokens])
    ends = np.cumsum(sizes + 1) - 1
    body = np.ones(len(cur), bool)
    body[ends] = False
    base = np.full(len(cur), np.log10(m["texts"] + 1.0))
    base[body] = log_c[tokens]
    model = m["table"][prev, cur]
    model[body] += rare[tokens]
    place = np.full(len(cur), -1, np.int64)
    place[body] = tokens
    own_terms(model, prev, cur, place, learned, v, classes, m)
    known = np.full(len(cur), int(m["texts"] > 0), np.int64)
    known[body] = seen[tokens] > 0
    starts = ends - sizes
    return tuple(np.add.reduceat(x, starts) for x in (known, base, model))
