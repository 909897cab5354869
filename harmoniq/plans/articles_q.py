"""Article-intake bindings: U3 + W3 + P22 URL dedupe, P19/P20 keyword
filter, F9 HTML strip."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from harmoniq.functions.urls import lang_key
from harmoniq.operators.articles import (article_text, dedupe_by_url, keyword_filter,
                                         normalize_url)
from harmoniq.functions.text import strip_html
from harmoniq.plans import register
from harmoniq.plans.common import table

NORM_SQL = ("regexp_replace(regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), "
            "'[?#].*$', ''), '/+$', '')")


def feeds(spark, sf_dir):
    """Two feeds over pages: https pages as the first feed (rank 0), the
    rest as the second (rank 1), concatenated by name (U3)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    a = p.filter(F.col("url").startswith("https://")).withColumn("source_rank", F.lit(0))
    b = p.filter(~F.col("url").startswith("https://")).withColumn("source_rank", F.lit(1))
    return a.unionByName(b)


@register("dedupe_url_first", oracle=f"""
WITH f AS (
  SELECT page_id, url, CASE WHEN starts_with(url, 'https://') THEN 0 ELSE 1 END AS source_rank
  FROM pages WHERE trim(COALESCE(url, '')) <> ''
)
SELECT arg_min(page_id, (source_rank, page_id)) AS page_id, arg_min(url, (source_rank, page_id)) AS url,
       min(source_rank) AS source_rank
FROM f GROUP BY {NORM_SQL}""")
def dedupe_url_first(spark, sf_dir):
    return dedupe_by_url(feeds(spark, sf_dir), "url", ["source_rank", "page_id"],
                         key=normalize_url("url"))


@register("dedupe_host_first", oracle="""
SELECT arg_min(page_id, page_id) AS page_id, arg_min(url, page_id) AS url,
       lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)', 1)) AS host
FROM pages WHERE trim(COALESCE(url, '')) <> '' GROUP BY host""")
def dedupe_host_first(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1))
        .alias("host"))
    return dedupe_by_url(p, "url", ["page_id"], scope=["host"], key=F.lit(""))


# fixed values: demo keyword lists over the synthetic prose (frequent tokens)
DEMO_KEYWORDS = {
    "en": (["thtion", "attion", "ertion"], ["thanea"]),
    "fr": (["oument", "aiment"], ["queque"]),
    "de": (["enlich", "enheit"], ["erkeit"]),
    "es": (["ciónas", "ciónue"], ["ciónado"]),
}


def _re2_alt(words):
    return "|".join(re.escape(w) for w in words)


def _keyword_sql():
    cases = []
    for lg, (pos, neg) in DEMO_KEYWORDS.items():
        cases.append(f"WHEN lk = '{lg}' THEN NOT regexp_matches(txt, '{_re2_alt(neg)}', 'i') "
                     f"AND regexp_matches(txt, '{_re2_alt(pos)}', 'i')")
    return "CASE " + " ".join(cases) + " ELSE false END"


@register("keyword_filter", oracle=f"""
WITH d AS (
  SELECT doc_id, split_part(COALESCE(NULLIF(lang, ''), 'en'), '-', 1) AS lk,
         concat_ws(' ', NULLIF(split_part(text, chr(10), 1), ''),
                   NULLIF(substr(text, length(split_part(text, chr(10), 1)) + 2), '')) AS txt
  FROM documents
)
SELECT doc_id, lk AS lang FROM d WHERE {_keyword_sql()}""", headline=True)
def keyword_filter_q(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    title = F.substring_index("text", "\n", 1)
    lead = F.expr("substr(text, length(substring_index(text, '\\n', 1)) + 2)")
    x = d.select("doc_id", lang_key("lang").alias("lang"), article_text(title, lead).alias("txt"))
    return keyword_filter(x, "txt", "lang", DEMO_KEYWORDS).select("doc_id", "lang")


@register("html_strip_cap", oracle="""
SELECT page_id,
       left(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), 1500) AS lead,
       length(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) AS full_chars
FROM pages""")
def html_strip_cap(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", strip_html("html", 1500).alias("lead"),
                    F.length(strip_html("html")).cast("bigint").alias("full_chars"))


@register("dedupe_url_per_country", oracle="""
WITH f AS (
  SELECT page_id, url, upper(regexp_extract(url, '^[^/]*//[^/]*/([a-z]+)/', 1)) AS country, 0 AS source_rank
  FROM pages
  UNION ALL
  SELECT page_id, url, 'ZZ', 1 FROM pages WHERE starts_with(url, 'https://')
  UNION ALL
  SELECT page_id + 1000000, url, 'ZZ', 2 FROM pages WHERE starts_with(url, 'https://')
)
SELECT country, arg_min(page_id, (source_rank, page_id)) AS page_id, trim(url) AS url
FROM f WHERE trim(COALESCE(url, '')) <> '' GROUP BY country, trim(url)""")
def dedupe_url_per_country(spark, sf_dir):
    """W3 scoped per country: every page is pulled for its own country and
    the https ones a second (and third, overlapping) time for another
    country; first seen per (country, URL)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    home = p.select("page_id", "url", F.upper(F.regexp_extract("url", r"^[^/]*//[^/]*/([a-z]+)/", 1))
                    .alias("country"), F.lit(0).alias("source_rank"))
    https = p.filter(F.col("url").startswith("https://"))
    other = https.select("page_id", "url", F.lit("ZZ").alias("country"), F.lit(1).alias("source_rank"))
    again = https.select((F.col("page_id") + 1000000).alias("page_id"), "url", F.lit("ZZ").alias("country"),
                         F.lit(2).alias("source_rank"))
    kept = dedupe_by_url(home.unionByName(other).unionByName(again), "url", ["source_rank", "page_id"],
                         scope=["country"])
    return kept.select("country", "page_id", F.trim("url").alias("url"))
