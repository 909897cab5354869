"""Empirical-Bayes host reputation for URL filtering (native).

Labelled page outcomes are counted per host and shrunk level by level: the
suffix towards all pages, the registered domain towards its suffix, the host
towards its domain.  Each level's prior is a beta distribution whose strength
is estimated from the spread of the children around their parent (moments of
the beta-binomial).  A host passes when the lower bound of its posterior is
at least the threshold.

Results: a null url, or one without ``://``, has empty host and path and is
judged like any host named ''; a host without labels has its domain's
posterior mean; without any label the global mean is one half.  Repeated rows
are judged alike and each counts as an outcome; equal rules cannot occur, of
rules of equal length the one with the longer host wins; an empty table gives
an empty table; input columns named like a produced column are replaced.
Urls of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import store, without

# fixed values: the curated rules (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# fixed values: labels that registries of countries put before their own for
# names of one kind (com.mx, co.in, gov.uk); with a last label of two letters
# they make a suffix of two labels
SECOND_LEVEL = ("ac", "asso", "co", "com", "edu", "firm", "gen", "go", "gob", "gouv", "gov", "gub", "id", "ind", "info",
                "ltd", "me", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "police", "sch", "web")
MAX_RULES = 1000
THRESHOLD = 0.5
Z = 1.0
STRENGTH_RANGE = (1.0, 1000.0)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def two_label_suffix(host: Column) -> Column:
    """Whether names are registered under the host's last two labels."""
    two = F.substring_index(host, ".", -2)
    return (F.length(F.substring_index(host, ".", -1)) == 2) & F.contains(host, F.lit(".")) \
        & F.substring_index(two, ".", 1).isin(*SECOND_LEVEL)


def suffix_of(host: Column) -> Column:
    """The last two labels where SECOND_LEVEL says so, else the last; names
    under a private suffix of two labels count as one domain."""
    return F.when(two_label_suffix(host), F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(two_label_suffix(host), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def match_rule(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.  Rules
    are a curated list (at most MAX_RULES), tried longest first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    best = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[0] + r[1])):
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(best)
    return best


def level_strength(children: DataFrame) -> float:
    """Strength of the beta prior of a level, from rows (n, k, pn, pk) of
    children and their parents: the intra-class correlation by moments, rho;
    strength = (1 - rho) / rho within STRENGTH_RANGE."""
    x = children.filter("n > 0").withColumn("m", F.try_divide("pk", "pn")) \
        .withColumn("v", F.col("m") * (1 - F.col("m")) * (1 - F.try_divide("n", "pn")))
    r = x.agg(F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), F.lit(2.0))).alias("s"),
              F.sum("v").alias("a"), F.sum(F.col("v") * (F.col("n") - 1)).alias("b")).first()
    lo, hi = STRENGTH_RANGE
    if not r["b"]:
        return hi
    rho = max(0.0, (r["s"] - r["a"]) / r["b"])
    return hi if rho <= 0 else min(hi, max(lo, (1 - rho) / rho)) if rho < 1 else lo


def shrunk(strength: float, up: Column) -> Column:
    """Posterior mean of counts (n, k) under the parent's mean."""
    return (F.col("k") + F.lit(strength) * up) / (F.col("n") + F.lit(strength))


def host_reputation(outcomes: DataFrame, z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """(host, n, k, mean, bound, verdict) for every host of ``outcomes`` (host,
    good): good is true, false, or null where the page has no label."""
    hosts = (outcomes.groupBy("host")
             .agg(F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("bigint")), F.lit(0)).alias("k"))
             .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    hosts = store(hosts, "host-counts")
    total = lambda df, *key: df.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    under = lambda df: df.select(*df.columns[:-2], F.col("n").alias("pn"), F.col("k").alias("pk"))
    domains = total(hosts, "domain", "suffix")
    suffixes = total(domains, "suffix")
    top = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    s_host = level_strength(hosts.join(under(total(hosts, "domain")), "domain"))
    s_domain = level_strength(domains.join(under(suffixes), "suffix"))
    s_suffix = level_strength(suffixes.withColumn("pn", F.lit(top["n"])).withColumn("pk", F.lit(top["k"])))
    mean = F.lit((top["k"] + 0.5) / (top["n"] + 1.0))
    by_suffix = suffixes.select("suffix", shrunk(s_suffix, mean).alias("up"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", shrunk(s_domain, F.col("up")).alias("up"))
    by_host = hosts.join(by_domain, "domain").withColumn("mean", shrunk(s_host, F.col("up")))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(s_host + 1.0)))
    return (by_host.withColumn("bound", F.col("mean") - F.lit(z) * spread)
            .select("host", "n", "k", "mean", "bound",
                    F.when(F.col("bound") >= threshold, "allow").otherwise("block").alias("verdict")))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url",
               good: Column | None = None, z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """Append host, path, rule and verdict.  ``good`` labels pages (boolean or
    null); by default the pages that the curated rules decide are the
    labelled outcomes."""
    made = ["host", "path", "rule", "verdict"]
    p = without(pages.withColumn("__url", F.col(url_col)), *made, "__fit", "__repute")
    p = p.withColumn("host", F.coalesce(host_of("__url"), F.lit(""))) \
         .withColumn("path", F.coalesce(path_of("__url"), F.lit(""))) \
         .withColumn("__fit", match_rule("host", "path", rules))
    label = good if good is not None else F.col("__fit.verdict") == "allow"
    reputation = host_reputation(p.select("host", label.alias("good")), z, threshold)
    out = p.join(reputation.select("host", F.col("verdict").alias("__repute")), "host", "left")
    keep = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in made]
    return out.select(*keep, "host", "path", F.col("__fit.rule").alias("rule"),
                      F.coalesce(F.col("__fit.verdict"), F.col("__repute")).alias("verdict"))


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_SECOND = ", ".join(f"'{s}'" for s in SECOND_LEVEL)
_TWO = f"len(string_split(host, '.')) >= 2 AND length(string_split(host, '.')[-1]) = 2 AND string_split(host, '.')[-2] IN ({_SECOND})"


def _strength_sql(name: str, children: str, parents: str, key: str) -> str:
    lo, hi = STRENGTH_RANGE
    return f"""{name} AS (
  SELECT CASE WHEN coalesce(b, 0) = 0 OR s <= a THEN {hi}
              WHEN (s - a) / b >= 1 THEN {lo}
              ELSE least({hi}, greatest({lo}, (1 - (s - a) / b) / ((s - a) / b))) END AS v
  FROM (SELECT sum(c.n * (c.k / c.n - p.k / p.n) ** 2) AS s,
               sum((p.k / p.n) * (1 - p.k / p.n) * (1 - c.n / p.n)) AS a,
               sum((p.k / p.n) * (1 - p.k / p.n) * (1 - c.n / p.n) * (c.n - 1)) AS b
        FROM {children} c JOIN {parents} p USING ({key}) WHERE c.n > 0))"""


ORACLE_SQL = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (
  SELECT parts.*, (SELECT arg_max({{'rule': rhost || rpath, 'verdict': rverdict}}, length(rhost || rpath)) FROM rules
                   WHERE (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)) AS f FROM parts),
hosts AS (
  SELECT host, count(f.verdict)::DOUBLE AS n, coalesce(sum((f.verdict = 'allow')::INT), 0)::DOUBLE AS k,
         CASE WHEN {_TWO}
              THEN list_aggregate(list_slice(string_split(host, '.'), -3, -1), 'string_agg', '.')
              ELSE list_aggregate(list_slice(string_split(host, '.'), -2, -1), 'string_agg', '.') END AS domain,
         CASE WHEN {_TWO}
              THEN list_aggregate(list_slice(string_split(host, '.'), -2, -1), 'string_agg', '.')
              ELSE string_split(host, '.')[-1] END AS suffix
  FROM fit GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, 1 AS top, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
tops AS (SELECT 1 AS top, sum(n) AS n, sum(k) AS k FROM suffixes),
{_strength_sql('s_host', 'hosts', 'domains', 'domain')},
{_strength_sql('s_domain', 'domains', 'suffixes', 'suffix')},
{_strength_sql('s_suffix', 'suffixes', 'tops', 'top')},
m_suffix AS (
  SELECT x.suffix, (x.k + (SELECT v FROM s_suffix) * ((t.k + 0.5) / (t.n + 1.0))) / (x.n + (SELECT v FROM s_suffix)) AS m
  FROM suffixes x JOIN tops t USING (top)),
m_domain AS (
  SELECT x.domain, (x.k + (SELECT v FROM s_domain) * u.m) / (x.n + (SELECT v FROM s_domain)) AS m
  FROM domains x JOIN m_suffix u USING (suffix)),
m_host AS (
  SELECT x.host, x.n, (x.k + (SELECT v FROM s_host) * u.m) / (x.n + (SELECT v FROM s_host)) AS m
  FROM hosts x JOIN m_domain u USING (domain)),
repute AS (
  SELECT host, CASE WHEN m - {Z} * sqrt(m * (1 - m) / (n + (SELECT v FROM s_host) + 1.0)) >= {THRESHOLD}
                    THEN 'allow' ELSE 'block' END AS verdict FROM m_host)
SELECT page_id, host, path, f.rule AS rule, coalesce(f.verdict, verdict) AS verdict
FROM fit JOIN repute USING (host)
"""
