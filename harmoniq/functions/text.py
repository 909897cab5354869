"""String cleaning column functions (all JVM-side, no UDF)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _accent_table() -> tuple[str, str]:
    """Pairs (accented char, base letter) for Latin-1 Supplement + Latin
    Extended-A, derived from Unicode NFD: a char whose decomposition is one
    ASCII letter followed by combining marks maps to that letter."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0180):
        ch = chr(cp)
        decomp = unicodedata.normalize("NFD", ch)
        base = decomp[0]
        marks = decomp[1:]
        if len(decomp) > 1 and base.isascii() and base.isalpha() and all(
                unicodedata.category(m) == "Mn" for m in marks):
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_ACCENTED, _BASES = _accent_table()


def strip_accents(col) -> Column:
    """drop combining accents (NFD, remove Mn) over the Latin range."""
    return F.translate(_c(col), _ACCENTED, _BASES)


def fold_key(col) -> Column:
    """Accent-stripped, lower-cased, trimmed lookup key."""
    return F.lower(F.trim(strip_accents(col)))


def collapse_ws(col) -> Column:
    """collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def drop_note_tag(col) -> Column:
    """remove a trailing ``[note N]`` tag."""
    return F.regexp_replace(_c(col), r"\s*\[note\s+\d+\]\s*$", "")


def clean_header(col) -> Column:
    """P10 + F6 + F7 on header text."""
    return collapse_ws(drop_note_tag(collapse_ws(col)))


def strip_html(col, cap: int | None = None) -> Column:
    """tags to spaces, white space at both ends off, optional length cap."""
    out = F.regexp_replace(F.regexp_replace(_c(col), r"<[^>]+>", " "), r"^\s+|\s+$", "")
    return F.left(out, F.lit(cap)) if cap else out


def blank_to_null(col) -> Column:
    return F.nullif(_c(col), F.lit(""))


def first_non_empty(*cols) -> Column:
    """First non-null, non-empty value."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def lenient_long(col, missing: str = "zero") -> Column:
    """Tolerant numeric parse.  ``missing='zero'`` turns junk into 0,
    ``missing='null'`` leaves NULL so the caller can drop the row.  Doubles
    are truncated toward zero like an integer cast."""
    out = F.trim(_c(col)).try_cast("double").try_cast("bigint")
    return F.coalesce(out, F.lit(0).cast("bigint")) if missing == "zero" else out


def digits_only_long(col) -> Column:
    """Strip '.' and ',' thousands separators; '', '-', '.' and any
    non-digit leftovers are missing (NULL)."""
    s = F.regexp_replace(F.trim(_c(col)), r"[.,]", "")
    return F.when(s.rlike(r"^[0-9]+$"), s.try_cast("bigint"))


def decimal_comma(col) -> Column:
    """S3: '0,0135' -> 0.0135 (NULL on junk)."""
    return F.regexp_replace(F.trim(_c(col)), ",", ".").try_cast("double")
