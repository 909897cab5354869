"""URL host, confidence score and keyword matching columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: police press-release outlets that make a record HIGH
POLICE_PR_OUTLETS = (
    "presseportal.de", "polizei.de", "polizia.it", "interno.gov.it",
    "interior.gob.es", "police.gov.uk", "police.uk", "interieur.gouv.fr",
    "politi.dk", "polisen.se",
)


AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_domain(url) -> Column:
    """lower-cased host without one leading 'www.'; no authority -> ''.
    The authority is cut out by its delimiters (user info and port dropped),
    so characters that a strict parser refuses elsewhere do not lose it."""
    host = F.lower(F.coalesce(F.regexp_extract(F.ltrim(_c(url)), AUTHORITY, 1), F.lit("")))
    return F.regexp_replace(host, r"^www\.", "")


def distinct_domains(url_array) -> Column:
    """Distinct non-empty domains of an array of URLs (NULL/'' skipped)."""
    urls = F.filter(_c(url_array), lambda u: u.isNotNull() & (u != ""))
    return F.array_distinct(F.filter(F.transform(urls, url_domain), lambda d: d != ""))


def is_listed_outlet(domain, outlets=POLICE_PR_OUTLETS) -> Column:
    lst = F.array(*[F.lit(o) for o in outlets])
    d = _c(domain)
    return F.exists(lst, lambda o: (d == o) | d.endswith(F.concat(F.lit("."), o)))


def confidence(domains, outlets=POLICE_PR_OUTLETS) -> Column:
    """HIGH if any domain is (a subdomain of) a listed outlet, MEDIUM if
    at least two distinct domains, else LOW."""
    lst = F.array(*[F.lit(o) for o in outlets])
    listed = F.exists(_c(domains), lambda d: F.exists(
        lst, lambda o: (d == o) | d.endswith(F.concat(F.lit("."), o))))
    return (F.when(listed, F.lit("HIGH"))
            .when(F.size(_c(domains)) >= 2, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def lang_key(language, name_to_code: dict | None = None) -> Column:
    """P20: language key, default 'en', part before '-'; optional map of
    language names ('english') to codes."""
    base = F.split_part(F.coalesce(F.nullif(_c(language), F.lit("")), F.lit("en")),
                        F.lit("-"), F.lit(1))
    if name_to_code:
        m = F.create_map(*[x for k, v in name_to_code.items() for x in (F.lit(k), F.lit(v))])
        base = F.coalesce(F.element_at(m, F.lower(base)), base)
    return base


def keyword_pattern(words, word_boundary: bool = False) -> str:
    """Case-insensitive alternation of literal words (Java regex)."""
    if not words:
        return "$^"
    alts = "|".join(r"\Q" + w + r"\E" for w in words)
    if word_boundary:
        alts = r"\b(?:" + alts + r")\b"
    return "(?iu)" + alts
