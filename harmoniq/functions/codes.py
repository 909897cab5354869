"""Region-code hierarchy, period and file-name functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F3 ------------------------------------------------------------------------
def level_of(code) -> Column:
    """Level = max(0, len - 2): 'DE' 0, 'DE1' 1, 'DE11' 2, 'DE111' 3."""
    return F.greatest(F.length(_c(code)) - 2, F.lit(0))


def parent_of(code) -> Column:
    """Drop the last character; level-0 codes have no parent."""
    c = _c(code)
    return F.when(F.length(c) > 2, F.left(c, F.length(c) - 1))


def country_of(code) -> Column:
    return F.left(_c(code), F.lit(2))


# Periods ---------------------------------------------------------------------
def year_start(year) -> Column:
    """First day of a calendar year."""
    return F.make_date(_c(year).cast("int"), F.lit(1), F.lit(1))


def year_end(year) -> Column:
    return F.make_date(_c(year).cast("int"), F.lit(12), F.lit(31))


def rolling_12m(month, year) -> tuple[Column, Column]:
    """A release 'year ending <month> <year>' covers 12 months ending on
    the last day of that month."""
    end = F.last_day(F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1)))
    start = F.date_add(F.add_months(end, -12), 1)
    return start, end


def month_window(month) -> tuple[Column, Column]:
    """'YYYY-MM' -> [first of next month - 40 days, first of next month)."""
    until = F.add_months(F.to_date(F.concat(_c(month), F.lit("-01"))), 1)
    return F.date_sub(until, 40), until


def year_of(col) -> Column:
    """year as BIGINT (matches SQL EXTRACT)."""
    return F.year(_c(col)).cast("bigint")


def quarter_code(col) -> tuple[Column, Column]:
    """F8: '2007K1' -> (2007, 1)."""
    c = _c(col)
    return F.substring(c, 1, 4).try_cast("int"), F.substring(c, 6, 1).try_cast("int")


def feed_instant(col) -> Column:
    """a feed's date text -> ISO-8601 UTC text, NULL if it is no date.
    Read are 'Mon, 01 Jan 2024 10:00:00 +0100' (week day and seconds may be
    missing, zones GMT, UT, UTC and Z count as +0000) and ISO dates and date
    times; without a zone they are UTC."""
    c = F.trim(_c(col))
    spelled = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z]+,?\s+", ""), r"\s+(GMT|UTC|UT|Z)$", " +0000")
    iso = F.regexp_replace(F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2}) ", "$1T"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(c, F.lit("T00:00:00Z"))) \
        .when(iso.rlike(r"(Z|[+-]\d{2}:\d{2})$") & iso.contains("T"), iso).otherwise(F.concat(iso, F.lit("Z")))
    at = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), iso.try_cast("timestamp")).otherwise(F.coalesce(
        F.try_to_timestamp(spelled, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(spelled, F.lit("d MMM yyyy HH:mm Z"))))
    # seconds since the epoch on a clock without zone: the session's zone does not matter
    utc = F.timestamp_add("SECOND", F.unix_seconds(at), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def period_code_year(col) -> Column:
    """F8: '2024JJ00' -> 2024."""
    return F.substring(_c(col), 1, 4).try_cast("int")


# File names ------------------------------------------------------------------
# fixed value: month words accepted in release file names
MONTHS = ("january", "february", "march", "april", "may", "june", "july",
          "august", "september", "october", "november", "december")


def release_from_name(name) -> tuple[Column, Column]:
    """P16: '...year ending <Month> <YYYY>...' (any case) -> (month, year);
    NULLs when the name does not match."""
    pat = r"(?i)(" + "|".join(MONTHS) + r")[ _-]*([0-9]{4})"
    word = F.lower(F.regexp_extract(_c(name), pat, 1))
    yr = F.regexp_extract(_c(name), pat, 2)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), word).cast("int")
    return (F.when(month > 0, month), F.when(yr != "", yr.cast("int")))


def label_by_rules(col, rules: list[tuple[str, str]], default: str) -> Column:
    """First matching substring rule wins (case-insensitive)."""
    low = F.lower(_c(col))
    out = None
    for needle, label in rules:
        cond = low.contains(needle.lower())
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)
