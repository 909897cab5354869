"""Identity and hashing: hard dedupe key, stable UUIDv5 id, content hash."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: namespace of the stable incident id
INCIDENT_NAMESPACE = "8e7eb8a6-3f60-4f51-9efb-f4a4dd5b3b6f"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(col) -> Column:
    """Trim all leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def hard_key(date_incident, date_reported, country, city, weapon, victim_fatal_text) -> Column:
    """md5 of 'date|country|city|weapon|fatal'.

    date = first non-empty of date_incident, date_reported, else '';
    city lower-cased and stripped; NULL country/weapon count as ''.
    ``victim_fatal_text`` is the already-rendered text of victim_fatal
    (absent -> '0', JSON null -> 'None'; see :func:`fatal_text`)."""
    date = F.coalesce(F.nullif(_c(date_incident), F.lit("")),
                      F.nullif(_c(date_reported), F.lit("")), F.lit(""))
    parts = [date,
             F.coalesce(_c(country), F.lit("")),
             F.lower(py_strip(F.coalesce(_c(city), F.lit("")))),
             F.coalesce(_c(weapon), F.lit("")),
             _c(victim_fatal_text)]
    return F.md5(F.concat_ws("|", *parts))


def fatal_text(value, present=None, absent_text: str = "0") -> Column:
    """Render an integer field the way Python's str() would: NULL that was
    present in the record -> 'None', absent -> ``absent_text``."""
    v = _c(value).cast("string")
    if present is None:
        return F.coalesce(v, F.lit(absent_text))
    return F.when(_c(present), F.coalesce(v, F.lit("None"))).otherwise(F.lit(absent_text))


def uuid5(name, namespace: str = INCIDENT_NAMESPACE) -> Column:
    """RFC 4122 version-5 UUID of ``name`` (UTF-8) in ``namespace``,
    computed natively: sha1(namespace bytes || name bytes), first 16 bytes,
    version nibble 5, variant bits 10."""
    ns_hex = uuid.UUID(namespace).hex
    h = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(_c(name), "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(h, 1, 8), F.lit("-"),
                    F.substring(h, 9, 4), F.lit("-5"),
                    F.substring(h, 14, 3), F.lit("-"),
                    variant, F.substring(h, 18, 3), F.lit("-"),
                    F.substring(h, 21, 12))


def incident_id(date_incident, country, city, weapon, victim_fatal_text) -> Column:
    """F13 key: 'date_incident|country|city|weapon|victim_fatal' with each
    part rendered like Python str(rec.get(k, '')): absent -> '', JSON null ->
    'None'.  Callers pass already-rendered text columns."""
    return uuid5(F.concat_ws("|", _c(date_incident), _c(country), _c(city),
                             _c(weapon), _c(victim_fatal_text)))


def py_text(value, present=None) -> Column:
    """str(rec.get(k, '')): absent -> '', present NULL -> 'None'."""
    v = _c(value).cast("string")
    if present is None:
        return F.coalesce(v, F.lit(""))
    return F.when(_c(present), F.coalesce(v, F.lit("None"))).otherwise(F.lit(""))


def content_hash(content) -> Column:
    """SHA-256 hex of bytes or text."""
    return F.sha2(_c(content), 256)
