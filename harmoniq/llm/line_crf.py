"""Line labelling by a linear-chain conditional random field.

Each line with a word is content or boilerplate.  Line features (length,
symbol, digit and capital shares, sentence end, separators, repetition) feed
a two-label chain; Viterbi decoding labels a text's lines and the content
share of its words decides whether it is kept.

The chain is trained here, on a bounded sample of line runs (``max_runs``, a
documented parameter; a run is up to ``run_lines`` lines, so any stretch of a
long text may be drawn, its first and last lines like the others; chosen by hash,
equal texts once), by gradient ascent on the conditional likelihood.  Its training labels are weak: a line is
boilerplate where symbols, separators, capitals, repetition or non-words
dominate it, and takes part in runs.  Every document is then decoded whole.

Results: a null or empty text has no words, fails the base rule and is not
kept; ties in decoding go to content; repeated rows are judged alike; lines
of any number and length are decoded; input columns named like a produced
column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import as_bytes, bounded, record_batch, text_hash, without

# fixed values: symbol characters; the base rule's limits
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_RUNS, RUN_LINES = 1500, 400
MIN_CONTENT = 0.5
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
N_FEATURES = 10
_SPACES = bytes(b" \t\n\x0b\x0c\r")
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))


# ---- base counts ------------------------------------------------------------------------
def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    pair = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1]
    window = pair[:-1].astype(np.int64) * len(ids) + code[2:]
    _, at, count = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[at] > 1)
    hit = np.zeros(n, bool)
    for j in range(3):
        hit[starts + j] = True
    return int(hit.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = text.split()
    n = len(words)
    joined = text.translate(None, _SPACES)
    # code points: bytes that are not continuation bytes
    chars = len(joined.translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(_SPACES):
            seen.add(line)
    repeat = repeated_words(words)
    return n, chars, symbols, dup, repeat, n < MIN_WORDS or 100 * repeat > 50 * n


# ---- line features --------------------------------------------------------------------------
def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the lines with a word."""
    x, words, seen = [], [], set()
    for line in lines:
        w = line.split()
        if not w:
            continue
        size = len(line)
        symbols = size - len(line.translate(None, SYMBOLS))
        separators = sum(1 for t in w if t in (b"|", b"-", b">", b"/", b"\xc2\xb7"))
        upper = size - len(line.translate(None, _UPPER))
        digits = size - len(line.translate(None, _DIGIT))
        x.append((1.0, min(len(w), 20) / 20, math.log1p(len(w)) / 5, min(1.0, 10 * symbols / size),
                  min(1.0, 4 * separators / len(w)), upper / size, digits / size,
                  float(line.rstrip()[-1:] in b".!?:;\"'"), 1 - len(set(w)) / len(w), float(line in seen)))
        words.append(len(w))
        seen.add(line)
    return np.array(x, np.float64).reshape(-1, N_FEATURES), np.array(words, np.int64)


def weak_labels(x: np.ndarray) -> np.ndarray:
    """1 boilerplate, 0 content, from the features that mark junk by themselves."""
    junk = (x[:, 3] >= 0.2) | (x[:, 4] >= 0.3) | (x[:, 5] >= 0.4) | (x[:, 6] >= 0.3) | (x[:, 8] >= 0.6) \
        | ((x[:, 9] > 0) & (x[:, 7] == 0)) | ((x[:, 1] <= 0.1) & (x[:, 7] == 0))
    return junk.astype(np.int64)


# ---- the chain ----------------------------------------------------------------------------------
def forward_backward(emit: np.ndarray, trans: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """log Z, label marginals (lines x 2) and summed transition marginals."""
    n = len(emit)
    a, b = np.empty((n, 2)), np.zeros((n, 2))
    a[0] = emit[0]
    for i in range(1, n):
        a[i] = emit[i] + np.logaddexp(a[i - 1, 0] + trans[0], a[i - 1, 1] + trans[1])
    for i in range(n - 2, -1, -1):
        nxt = emit[i + 1] + b[i + 1]
        b[i] = np.logaddexp(trans[:, 0] + nxt[0], trans[:, 1] + nxt[1])
    z = np.logaddexp(a[-1, 0], a[-1, 1])
    pair = np.exp(a[:-1, :, None] + trans[None] + (emit[1:] + b[1:])[:, None, :] - z).sum(axis=0) if n > 1 \
        else np.zeros((2, 2))
    return z, np.exp(a + b - z), pair


def train_chain(pieces: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.3,
                l2: float = 1e-3) -> dict:
    """Stochastic gradient ascent on log P(labels | lines)."""
    w, trans = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    g_w, g_t = np.full_like(w, 1e-8), np.full_like(trans, 1e-8)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(pieces)):
            x, y = pieces[k]
            _, p, pair = forward_backward(x @ w, trans)
            want = np.eye(2)[y]
            d_w = x.T @ (want - p) / len(x) - l2 * w
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            d_t = (seen - pair) / len(x) - l2 * trans
            g_w += d_w ** 2
            g_t += d_t ** 2
            w += rate * d_w / np.sqrt(g_w)
            trans += rate * d_t / np.sqrt(g_t)
    return {"w": w, "trans": trans}


def viterbi(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label sequence; ties go to label 0 (content)."""
    n = len(emit)
    back0, back1 = bytearray(n), bytearray(n)
    e = emit.tolist()
    (t00, t01), (t10, t11) = trans.tolist()
    s0, s1 = e[0]
    for i in range(1, n):
        a, b = s0 + t00, s1 + t10
        c, d = s0 + t01, s1 + t11
        back0[i], back1[i] = b > a, d > c
        s0, s1 = (b if b > a else a) + e[i][0], (d if d > c else c) + e[i][1]
    out = np.zeros(n, np.int64)
    label = int(s1 > s0)
    for i in range(n - 1, -1, -1):
        out[i] = label
        label = (back1 if label else back0)[i]
    return out


def content_share(text: bytes, model: dict) -> float:
    """Share of words on lines decoded as content; 0 without words."""
    x, words = line_features(text.split(b"\n"))
    if not len(x):
        return 0.0
    label = viterbi(x @ model["w"], model["trans"])
    return float(words[label == 0].sum() / words.sum())


# ---- operators -------------------------------------------------------------------------------------
def fit(docs: DataFrame, text_col: str = "text", max_runs: int = MAX_RUNS, run_lines: int = RUN_LINES) -> dict:
    """Train the chain on at most ``max_runs`` runs of lines of different texts;
    lines become feature rows in the tasks, with the features that they have in
    their whole text.  The runs are drawn on hashes of text and place, copies
    being one, so a large group of copies cannot fill the sample; only drawn
    texts are shuffled."""
    text = F.col("text")
    rows = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null") \
        .withColumn("h", text_hash("text"))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    runs = rows.select("h", F.ceil(lines / run_lines).cast("int").alias("n")).distinct() \
        .select("h", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("run"))
    chosen = runs.orderBy(F.xxhash64("h", "run"), "h", "run").limit(max_runs)
    drawn = F.broadcast(chosen.groupBy("h").agg(F.collect_set("run").alias("runs")))   # max_runs numbers at most
    sample = rows.join(drawn, "h").groupBy("h").agg(F.any_value("text").alias("text"), F.any_value("runs").alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in bounded(batches, "text", 4 << 20):
            out = []
            for t, runs in zip(as_bytes(b.column("text")), b.column("runs").to_pylist(), strict=True):
                split = t.split(b"\n")
                place = np.flatnonzero([bool(line.strip(_SPACES)) for line in split]) // run_lines
                x = line_features(split)[0].astype(np.float32)
                out += [x[place == k].tobytes() for k in sorted(runs)]
            yield record_batch(["x"], [pa.array(out, pa.binary())])
    got = sample.select("text", "runs").mapInArrow(run, "x binary").collect()
    texts = []
    for r in sorted(bytes(r["x"]) for r in got):
        x = np.frombuffer(r, np.float32).reshape(-1, N_FEATURES).astype(np.float64)
        if len(x):
            texts.append((x, weak_labels(x)))
    return train_chain(texts)


def judge(docs: DataFrame, model: dict, text_col: str = "text", keep: list[Column | str] | None = None,
          min_content: float = MIN_CONTENT) -> DataFrame:
    """Append the base counts, content_share and kept to the rows (or to the
    columns of ``keep``).  Map-only."""
    made = [c.split()[0] for c in BASE.split(", ")] + ["kept", "content_share"]
    src = docs if keep is None else docs.select(*keep, F.col(text_col))
    src = src.withColumn("__text", F.col(text_col).cast("string"))
    src = without(src, *made, *([text_col] if keep is not None else []))
    out_cols = [c for c in src.columns if c != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text"]
                       + [BASE, "kept boolean", "content_share double"])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in bounded(batches, "__text", 4 << 20):
            texts = as_bytes(b.column("__text"))
            base = [base_counts(t) for t in texts]
            share = [content_share(t, model) for t in texts]
            kept = [not x[5] and s >= min_content for x, s in zip(base, share)]
            cols = [pa.array([x[i] for x in base], pa.bool_() if i == 5 else pa.int64()) for i in range(6)]
            yield record_batch(out_cols + made, [b.column(c) for c in out_cols] + cols
                               + [pa.array(kept, pa.bool_()), pa.array(share, pa.float64())])
    return src.mapInArrow(run, schema)
