"""Multilingual mixture inference: which languages a text is made of.

A document's letter trigrams are a mixture of language profiles.
Expectation-maximisation estimates the proportions; the language set is the
one with the best likelihood less a penalty per language, of any size up to
the number of learned languages.  Profiles are counts over all labelled
training documents.

Results: ``lang_pred`` is the largest language of the chosen set (ties: the
first in code-point order) and ``score`` its proportion; a null or empty text,
a text without a letter, and any text when nothing was learned give 'und'
and 0.  Text is read whole whatever its length; case (A-Z) and anything but
letters do not count.  Rows with a null language teach nothing; repeated rows
count each time.  Input columns named like a produced column are replaced;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import bounded, record_batch, utf8, without

BITS = 12
MAX_LANGUAGES = 512
EM_STEPS = 10
OVERLAP = 3.0               # each letter lies in three trigrams
PENALTY = 4.0               # times ln(letters) / 2 for each further language
SMOOTH = 0.5
_FOLD = np.full(256, 32, np.uint8)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def trigram_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hashed letter-trigram counts, one row per text (float32)."""
    n = len(off) - 1
    x = _FOLD[data].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    if len(x) < 3:
        return np.zeros((n, 1 << BITS), np.float32)
    code = x[:-2] | (x[1:-1] << np.uint32(8)) | (x[2:] << np.uint32(16))
    keep = (doc[:-2] == doc[2:]) & (x[1:-1] != 32)
    slot = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    at = (doc[:-2] << BITS) + slot
    return np.bincount(at[keep], minlength=n << BITS).reshape(n, 1 << BITS).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


# ---- learning -------------------------------------------------------------------------
def learn_profiles(train: DataFrame, lang_col: str = "lang", text_col: str = "text",
                   max_languages: int = MAX_LANGUAGES) -> dict[str, np.ndarray]:
    """Trigram counts per language over every training row.  Tasks add up
    before the shuffle; the driver gets languages x 2^BITS numbers, a bound
    that ``max_languages`` checks."""
    def count(batches: Iterator[pa.RecordBatch]):
        sums: dict[str, np.ndarray] = {}
        for b in bounded(batches, "text", 1 << 20, 256):
            h = trigram_counts(*utf8(b.column("text")))
            langs = np.array(b.column("lang").to_pylist(), object)
            for lang in set(langs):
                s = h[langs == lang].sum(axis=0, dtype=np.float64)
                sums[lang] = sums[lang] + s if lang in sums else s
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield record_batch(["lang", "slot", "n"], [pa.array([lang] * len(at), pa.string()),
                                                       at.astype(np.int32), s[at].astype(np.int64)])
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .filter("lang is not null and text is not null")
    parts = rows.mapInArrow(count, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    got = parts.limit((max_languages << BITS) + 1).toArrow()
    profiles: dict[str, np.ndarray] = {}
    langs = got.column("lang").to_pylist()
    names = np.array(langs, object)
    slot, n = got.column("slot").to_numpy(), got.column("n").to_numpy()
    for lang in sorted(set(langs), key=lambda s: s.encode("utf-8")):
        v = np.zeros(1 << BITS)
        v[slot[names == lang]] = n[names == lang]
        profiles[lang] = v
    if len(profiles) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return profiles


def likelihoods(profiles: dict[str, np.ndarray]) -> np.ndarray:
    """P(trigram | language), languages x 2^BITS, smoothed by the mean profile."""
    p = np.stack(list(profiles.values())) + SMOOTH
    p /= p.sum(axis=1, keepdims=True)
    p = 0.98 * p + 0.02 * p.mean(axis=0)
    return p.astype(np.float32)


# ---- inference ------------------------------------------------------------------------
def em(h: np.ndarray, p: np.ndarray, pi: np.ndarray, steps: int) -> np.ndarray:
    """EM for mixture proportions: pi_l <- sum_g h_g pi_l p_lg / sum_k pi_k p_kg / n."""
    n = np.maximum(h.sum(axis=1, keepdims=True), 1)
    for _ in range(steps):
        pi = pi * ((h / np.maximum(pi @ p, 1e-30)) @ p.T) / n
    return pi


def infer(h: np.ndarray, p: np.ndarray, steps: int = EM_STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Proportions (texts x languages) of the chosen language sets.  The nested
    sets of the largest 1, 2, .. languages of the full mixture are compared
    by log-likelihood / OVERLAP - penalty / 2 * size * ln(letters).  A text's
    sets grow until no larger one can win: no mixture's log-likelihood is above
    that of the full one + trigrams * ln(largest EM factor) (Jensen)."""
    n_docs, n_lang = len(h), len(p)
    full = em(h, p, np.full((n_docs, n_lang), 1.0 / n_lang, np.float32), steps)
    # the single language of the best likelihood leads; the others follow by proportion
    single = h @ np.log(p).T
    lead = single.argmax(axis=1)
    rank = full.copy()
    rank[np.arange(n_docs), lead] = 2
    order = np.argsort(-rank, axis=1, kind="stable")
    total = h.sum(axis=1)
    n = np.maximum(total / OVERLAP, 2)
    best = np.zeros_like(full)
    best[np.arange(n_docs), lead] = 1
    value = single[np.arange(n_docs), lead] / OVERLAP - penalty / 2 * np.log(n)
    mixed = np.maximum(full @ p, 1e-30)
    factor = ((h / mixed) @ p.T).max(axis=1) / np.maximum(total, 1)
    top = (np.einsum("ij,ij->i", h, np.log(mixed)) + total * np.log(np.maximum(factor, 1))) / OVERLAP
    top += 1e-4 * np.abs(top)                        # float32 sums
    for size in range(2, n_lang + 1):
        live = np.flatnonzero(top - penalty / 2 * size * np.log(n) > value)
        if not len(live):
            break
        pi = np.zeros((len(live), n_lang), np.float32)
        at = order[live, :size]
        np.put_along_axis(pi, at, np.maximum(np.take_along_axis(full[live], at, 1), 0.01), 1)
        pi /= pi.sum(axis=1, keepdims=True)
        some = h[live]
        pi = em(some, p, pi, steps // 2)
        fit = np.einsum("ij,ij->i", some, np.log(np.maximum(pi @ p, 1e-30))) / OVERLAP \
            - penalty / 2 * size * np.log(n[live])
        better = fit > value[live]
        best[live[better]], value[live[better]] = pi[better], fit[better]
    best[total == 0] = 1.0 / n_lang                  # letters, but no trigram: nothing to tell by
    return best


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text",
             keep: list[Column | str] | None = None) -> DataFrame:
    """Append lang_pred, score and mixture (map language -> proportion) to the
    rows (or to the columns of ``keep``).  Map-only."""
    langs = list(profiles)
    made = ("lang_pred", "score", "mixture")
    src = docs.withColumn("__text", F.col(text_col).cast("string")) if keep is None else \
        docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    src = without(src, *made)
    out_cols = [c for c in src.columns if c != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text"]
                       + ["lang_pred string", "score double", "mixture map<string,double>"])
    table = src.sparkSession.sparkContext.broadcast(likelihoods(profiles)) if langs else None

    def label(batches: Iterator[pa.RecordBatch]):
        for b in bounded(batches, "__text", 1 << 20, 256):
            n = b.num_rows
            letters = np.fromiter(map(has_letter, b.column("__text").to_pylist()), bool, n)
            pred, score = np.full(n, "und", object), np.zeros(n)
            mixture: list = [[]] * n
            if langs and letters.any():
                h = trigram_counts(*utf8(b.column("__text")))
                pi = infer(h, table.value)
                top = pi.argmax(axis=1)
                pred = np.where(letters, np.array(langs, object)[top], "und")
                score = np.where(letters, np.minimum(pi[np.arange(n), top].astype(float), 1.0), 0.0)
                mixture = [[(langs[j], float(pi[i, j])) for j in np.flatnonzero(pi[i] > 0)] if letters[i] else []
                           for i in range(n)]
            yield record_batch(out_cols + list(made), [b.column(c) for c in out_cols] + [
                pa.array(pred, pa.string()), score, pa.array(mixture, pa.map_(pa.string(), pa.float64()))])
    return src.mapInArrow(label, schema)


def keep_identified(docs: DataFrame, profiles: dict[str, np.ndarray], least: float = 0.5) -> DataFrame:
    """The rows whose text is identified with a share of at least ``least``;
    columns as they came."""
    marked = identify(docs, profiles, keep=[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text"])
    return marked.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("__row.*")
