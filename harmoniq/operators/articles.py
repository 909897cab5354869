"""Tier-2 intake: URL dedupe (first seen wins) and keyword filtering.

"First seen per key" is a grouped ``min_by(row, ordinal)`` rather than a
``row_number`` window: the aggregate is combined map-side, so a URL (or
host) that holds a third of all rows is pre-reduced in every task instead
of being sorted inside one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.functions.urls import keyword_pattern


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_url(url) -> Column:
    """Drop scheme, query, fragment and trailing slashes."""
    u = F.regexp_replace(F.trim(_c(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, r"[?#].*$", "")
    return F.regexp_replace(u, r"/+$", "")


def non_empty_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Keep records whose trimmed URL is non-empty."""
    return df.filter(F.trim(F.coalesce(F.col(url), F.lit(""))) != "")


def first_seen(df: DataFrame, keys: list, order: list[str], key_names: list[str] | None = None) -> DataFrame:
    """One survivor per key: the row with the smallest ``order`` tuple."""
    cols = df.columns
    key_cols = [(_c(k).alias(n) if n else _c(k)) for k, n in
                zip(keys, key_names or [None] * len(keys), strict=True)]
    g = df.groupBy(*key_cols).agg(
        F.min_by(F.struct(*cols), F.struct(*order)).alias("__row"))
    names = [c for c in g.columns if c != "__row"]
    return g.select(*names, "__row.*") if key_names else g.select("__row.*")


def dedupe_by_url(df: DataFrame, url: str, order: list[str], scope: list[str] | None = None,
                  key=None) -> DataFrame:
    """W3 (+P22): first-seen record per (scope..., trimmed URL or a derived
    key such as :func:`normalize_url`)."""
    k = key if key is not None else F.trim(F.col(url))
    kept = non_empty_url(df, url).withColumn("__url_key", k)
    out = first_seen(kept, [*(scope or []), "__url_key"], order)
    return out.drop("__url_key")


def article_text(title, lead) -> Column:
    """Title and lead joined by one space, empty parts skipped."""
    return F.concat_ws(" ", F.nullif(_c(title), F.lit("")), F.nullif(_c(lead), F.lit("")))


def keyword_match(text, lang, keywords: dict[str, tuple[list[str], list[str]]],
                  word_boundary: bool = False) -> Column:
    """Per language, any negative match rejects, else any positive
    match accepts; case-insensitive substring match; unknown language
    rejects.  Literal patterns per language (compiled once per task)."""
    t = _c(text)
    out = None
    for lg, (pos, neg) in keywords.items():
        verdict = (~F.coalesce(t.rlike(keyword_pattern(neg, word_boundary)), F.lit(False))
                   & F.coalesce(t.rlike(keyword_pattern(pos, word_boundary)), F.lit(False)))
        cond = _c(lang) == F.lit(lg)
        out = F.when(cond, verdict) if out is None else out.when(cond, verdict)
    return out.otherwise(F.lit(False)) if out is not None else F.lit(False)


def keyword_filter(df: DataFrame, text, lang, keywords, word_boundary: bool = False) -> DataFrame:
    return df.filter(keyword_match(text, lang, keywords, word_boundary))
