"""Sources as step lists (X1), their accounts (X2, A15, A18) and the table with
snapshot commits (J6) on the driver's tables.

Each stand-in input only has the columns and oddities that a publisher's rows
have: rollups, note tags, junk counts, several units, quarter codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmoniq.operators import catalogue
from harmoniq.operators.registry import run_registry
from harmoniq.operators.snapshots import read_snapshot, upsert_snapshot
from harmoniq.operators.steps import harmonise_source
from harmoniq.plans import register
from harmoniq.plans.common import AS_OF, CATEGORY_PAIRS, nation_code, region_dim, table
from harmoniq.schema import CRIME_AGGREGATES
from harmoniq.session import materialize, scratch_path

PAIRS = tuple(CATEGORY_PAIRS)
RELEASE = "pfatables-yearending-september-2025.xlsx"
OUT = ["source_country", "region_code", "region_level", "crime_category", "crime_category_native", "suspect_dim",
       "period_start", "period_end", "count", "denominator_population", "denominator_source", "rate_per_100k"]

# ---- the inputs, in SQL and in Spark --------------------------------------------------------
CATEGORY_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in PAIRS) + ") AS c(native, category)"
BASE_SQL = f"""
lines AS (SELECT n.n_nationkey AS nk, n.n_regionkey AS rk, n.n_name AS name,
                 l.l_returnflag || '|' || l.l_linestatus AS native, year(o.o_orderdate) AS y,
                 quarter(o.o_orderdate) AS q, SUM(CAST(l.l_quantity AS BIGINT)) AS qty
          FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
               JOIN nation n ON n.n_nationkey = s.s_nationkey GROUP BY ALL),
dim AS (SELECT n_nationkey AS nk, 'R' || n_regionkey || chr(65 + n_nationkey) AS code,
               (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS pop FROM nation),
cats AS (SELECT * FROM {CATEGORY_SQL}),
uk_in AS (SELECT nk, CASE WHEN nk % 5 = 4 THEN 'E12' WHEN nk % 2 = 1 THEN 'E23' ELSE 'W15' END AS prefix, native,
                 SUM(CASE WHEN nk % 7 = 3 AND native LIKE 'R%' THEN NULL ELSE qty END) AS n
          FROM lines GROUP BY nk, native),
fr_lines AS (SELECT nk, native, y * 2 - 1990 AS y, SUM(qty) AS qty FROM lines GROUP BY ALL),
fr_in AS (SELECT nk, native, y, u.unit,
                 CASE WHEN qty % 10 = 0 THEN NULL WHEN u.unit = 'Infraction' THEN qty + 1 ELSE qty END AS n, nk * 1000 + y AS own
          FROM fr_lines, (VALUES ('Victime'), ('Infraction'), ('Mis en cause')) AS u(unit)
          WHERE u.unit <> 'Victime' OR native LIKE 'A%'),
dk_in AS (SELECT nk, native, y, q, CASE WHEN qty % 10 = 0 THEN NULL ELSE qty END AS n FROM lines)"""


def _lines(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"),
                                              F.quarter("o_orderdate").alias("q"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.concat_ws("|", "l_returnflag", "l_linestatus").alias("native"),
        F.col("l_quantity").cast("bigint").alias("qty"))
    x = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey).join(
        n, s.s_nationkey == n.n_nationkey)
    return x.groupBy(F.col("n_nationkey").alias("nk"), "n_name", "native", "y", "q").agg(F.sum("qty").alias("qty"))


def _region_map(spark, sf_dir):
    """A landed mapping file's columns; nation 24 is not in it."""
    n = table(spark, sf_dir, "nation").filter("n_nationkey <> 24")
    return n.select(F.concat(F.lit("K"), F.col("n_nationkey").cast("string")).alias("native_code"),
                    F.col("n_name").alias("native_name"), nation_code("n_regionkey", "n_nationkey").alias("nuts_code"),
                    F.lit("").alias("notes"))


def uk_rows(spark, sf_dir, lines=None):
    x = (_lines(spark, sf_dir) if lines is None else lines).groupBy("nk", "n_name", "native").agg(F.sum("qty").alias("qty"))
    prefix = F.when(F.col("nk") % 5 == 4, "E12").when(F.col("nk") % 2 == 1, "E23").otherwise("W15")
    hidden = (F.col("nk") % 7 == 3) & F.col("native").startswith("R")
    return x.select(F.concat(prefix, F.lpad(F.col("nk").cast("string"), 6, "0")).alias("area_code"),
                    F.concat(F.initcap("n_name"), F.when(F.col("nk") % 3 == 0, " [note 2]").otherwise(" ")).alias("force_native"),
                    F.col("native").alias("offence_native"),
                    F.when(hidden, "[x]").otherwise(F.col("qty").cast("string")).alias("count"),
                    F.lit(RELEASE).alias("file"))


def fr_rows(spark, sf_dir, lines=None):
    x = (_lines(spark, sf_dir) if lines is None else lines).groupBy("nk", "native", (F.col("y") * 2 - 1990).alias("y")).agg(F.sum("qty").alias("qty"))
    units = F.when(F.col("native").startswith("A"), F.array(F.lit("Victime"), F.lit("Infraction"), F.lit("Mis en cause"))) \
        .otherwise(F.array(F.lit("Infraction"), F.lit("Mis en cause")))
    x = x.withColumn("unit", F.explode(units))
    n = F.when(F.col("qty") % 10 == 0, "n.d.").when(F.col("unit") == "Infraction", (F.col("qty") + 1).cast("string")) \
        .otherwise(F.col("qty").cast("string"))
    return x.select(F.concat(F.lit("K"), F.col("nk").cast("string")).alias("Code_departement"),
                    F.col("y").cast("string").alias("annee"), F.col("native").alias("indicateur"),
                    F.col("unit").alias("unite_de_compte"), n.alias("nombre"),
                    (F.col("nk") * 1000 + F.col("y")).cast("string").alias("insee_pop"))


def dk_rows(spark, sf_dir, lines=None):
    x = _lines(spark, sf_dir) if lines is None else lines
    return x.select(F.concat(F.lit("K"), F.col("nk").cast("string")).alias("OMRÅDE"), F.col("native").alias("OVERTRÆD"),
                    F.concat(F.col("y").cast("string"), F.lit("K"), F.col("q").cast("string")).alias("TID"),
                    F.when(F.col("qty") % 10 == 0, "..").otherwise(F.col("qty").cast("string")).alias("INDHOLD"))


def _some_regions(spark, sf_dir):
    """Every third nation has no population in the dimension."""
    d = region_dim(spark, sf_dir)
    return d.filter((F.col("level") == 0) | (F.pmod(F.ascii(F.substring("code", 3, 1)) - 65, F.lit(3)) != 0))


# ---- UK --------------------------------------------------------------------------------------
UK_SQL = """
uk AS (SELECT 'UK' AS source_country, d.code AS region_code, c.category AS crime_category,
              list_aggregate(list_sort(list_distinct(list(i.native)))[1:3], 'string_agg', ', ') AS crime_category_native,
              DATE '2024-10-01' AS period_start, DATE '2025-09-30' AS period_end, CAST(SUM(i.n) AS BIGINT) AS count,
              max(d.pop) AS denominator_population, 'ONS mid-2023 estimates' AS denominator_source
       FROM uk_in i JOIN cats c ON c.native = i.native JOIN dim d ON d.nk = i.nk
       WHERE i.prefix <> 'E12' AND i.n IS NOT NULL AND i.nk <> 24 GROUP BY d.code, c.category)"""


def _facts_sql(name: str) -> str:
    return f"""
SELECT source_country, region_code, CAST(1 AS INTEGER) AS region_level, crime_category, crime_category_native,
       'total' AS suspect_dim, period_start, period_end, count, denominator_population, denominator_source,
       count / denominator_population * 100000.0 AS rate_per_100k FROM {name}"""


@register("adapter_uk", oracle=f"WITH {BASE_SQL}, {UK_SQL} {_facts_sql('uk')}")
def adapter_uk(spark, sf_dir):
    """UK: area-code filter, suppressed counts dropped, force names (note tags,
    case) to regions, one rolling year from the file's name."""
    return harmonise_source(spark, uk_rows(spark, sf_dir), catalogue.uk(_region_map(spark, sf_dir), "u", PAIRS),
                            region_dim(spark, sf_dir), as_of=AS_OF).select(*OUT)


# ---- FR --------------------------------------------------------------------------------------
FR_SQL = """
fr_pref AS (SELECT i.native, max(CASE WHEN i.unit = 'Victime' THEN 1 ELSE 0 END) AS has
            FROM fr_in i JOIN cats c ON c.native = i.native WHERE i.nk <> 24 AND i.unit <> 'Mis en cause' GROUP BY 1),
fr_rows AS (SELECT i.*, c.category FROM fr_in i JOIN cats c ON c.native = i.native JOIN fr_pref p ON p.native = i.native
            WHERE i.nk <> 24 AND i.unit = CASE WHEN p.has = 1 THEN 'Victime' ELSE 'Infraction' END),
fr AS (SELECT 'FR' AS source_country, d.code AS region_code, i.category AS crime_category,
              list_aggregate(list_sort(list_distinct(list(i.native)))[1:3], 'string_agg', ', ') AS crime_category_native,
              make_date(CAST(i.y AS INTEGER), 1, 1) AS period_start, make_date(CAST(i.y AS INTEGER), 12, 31) AS period_end,
              CAST(SUM(coalesce(i.n, 0)) AS BIGINT) AS count,
              CASE WHEN i.nk % 3 <> 0 THEN max(d.pop) ELSE max(i.own) END AS denominator_population,
              CASE WHEN i.nk % 3 <> 0 THEN 'Eurostat NUTS 2021' ELSE 'INSEE recensement' END AS denominator_source
       FROM fr_rows i JOIN dim d ON d.nk = i.nk WHERE i.y > (SELECT max(y) FROM fr_rows) - 10
       GROUP BY d.code, i.category, i.y, i.nk)"""


@register("adapter_fr", oracle=f"WITH {BASE_SQL}, {FR_SQL} {_facts_sql('fr')}")
def adapter_fr(spark, sf_dir):
    """FR: victims preferred to offences per indicator, the last ten years, the
    source's own population where the dimension has none."""
    return harmonise_source(spark, fr_rows(spark, sf_dir), catalogue.fr(_region_map(spark, sf_dir), "u", PAIRS),
                            _some_regions(spark, sf_dir), as_of=AS_OF).select(*OUT)


# ---- DK --------------------------------------------------------------------------------------
DK_SQL = """
dk_rows AS (SELECT i.*, c.category, d.code, d.pop FROM dk_in i JOIN cats c ON c.native = i.native
            JOIN dim d ON d.nk = i.nk WHERE i.nk <> 24),
dk_sums AS (SELECT code, category, y, count(DISTINCT q) AS quarters, CAST(SUM(coalesce(n, 0)) AS BIGINT) AS count,
                   max(pop) AS pop, count(*) AS rows,
                   list_aggregate(list_sort(list_distinct(list(native)))[1:3], 'string_agg', ', ') AS examples
            FROM dk_rows GROUP BY ALL),
dk_last AS (SELECT max(y) AS y FROM dk_sums WHERE quarters = 4),
dk AS (SELECT 'DK' AS source_country, code AS region_code, category AS crime_category, examples AS crime_category_native,
              make_date(CAST(s.y AS INTEGER), 1, 1) AS period_start, make_date(CAST(s.y AS INTEGER), 12, 31) AS period_end,
              count, pop AS denominator_population, 'Eurostat NUTS 2021' AS denominator_source
       FROM dk_sums s, dk_last l WHERE s.y <= l.y AND s.y > l.y - 10)"""


@register("adapter_dk", oracle=f"WITH {BASE_SQL}, {DK_SQL} {_facts_sql('dk')}")
def adapter_dk(spark, sf_dir):
    """DK: quarter codes summed to years, up to the newest year that is complete."""
    return harmonise_source(spark, dk_rows(spark, sf_dir), catalogue.dk(_region_map(spark, sf_dir), "u", PAIRS),
                            region_dim(spark, sf_dir), as_of=AS_OF).select(*OUT)


# ---- accounts --------------------------------------------------------------------------------
def _account_sql(name: str, first: str, lost: dict, kept: str, coerced: str) -> str:
    names = ("filtered", "no_count", "no_period", "unmapped_category", "unmapped_region", "unmapped_dimension",
             "other_unit", "old_periods")
    cells = ", ".join(f"CAST({lost.get(n, '0')} AS BIGINT) AS {n}" for n in names)
    return f"""SELECT '{name}' AS source, 'ok' AS status, (SELECT count(*) FROM {first}_in) AS rows_in, {cells},
 CAST({kept} AS BIGINT) AS rows_kept, CAST({coerced} AS BIGINT) AS coerced, (SELECT count(*) FROM {first}) AS n_rows,
 (SELECT min(period_start) FROM {first}) AS min_period, (SELECT max(period_end) FROM {first}) AS max_period,
 (SELECT count(DISTINCT region_code) FROM {first}) AS n_regions"""


def _n(source: str, where: str) -> str:
    return f"(SELECT count(*) FROM {source} WHERE {where})"


KNOWN = "native IN (SELECT native FROM cats)"
FR_KEPT = "(SELECT count(*) FROM fr_rows WHERE y > (SELECT max(y) FROM fr_rows) - 10)"
FR_OLD = "(SELECT count(*) FROM fr_rows WHERE y <= (SELECT max(y) FROM fr_rows) - 10)"
UNIT = "unit <> 'Mis en cause'"
ACCOUNTS_SQL = " UNION ALL ".join([
    _account_sql("uk", "uk", {
        "filtered": _n("uk_in", "prefix = 'E12'"), "no_count": _n("uk_in", "prefix <> 'E12' AND n IS NULL"),
        "unmapped_region": _n("uk_in", "prefix <> 'E12' AND n IS NOT NULL AND nk = 24"),
        "unmapped_category": _n("uk_in", f"prefix <> 'E12' AND n IS NOT NULL AND nk <> 24 AND NOT {KNOWN}")},
        _n("uk_in", f"prefix <> 'E12' AND n IS NOT NULL AND nk <> 24 AND {KNOWN}"), "0"),
    _account_sql("fr", "fr", {
        "filtered": _n("fr_in", f"NOT {UNIT}"), "unmapped_category": _n("fr_in", f"{UNIT} AND NOT {KNOWN}"),
        "unmapped_region": _n("fr_in", f"{UNIT} AND {KNOWN} AND nk = 24"),
        "other_unit": _n("fr_in", f"{UNIT} AND {KNOWN} AND nk <> 24") + " - (SELECT count(*) FROM fr_rows)",
        "old_periods": FR_OLD}, FR_KEPT, _n("fr_in", f"{UNIT} AND n IS NULL")),
    _account_sql("dk", "dk", {
        "unmapped_category": _n("dk_in", f"NOT {KNOWN}"), "unmapped_region": _n("dk_in", f"{KNOWN} AND nk = 24"),
        "old_periods": "(SELECT coalesce(sum(rows), 0) FROM dk_sums s, dk_last l WHERE NOT (s.y <= l.y AND s.y > l.y - 10))"},
        "(SELECT sum(rows) FROM dk_sums s, dk_last l WHERE s.y <= l.y AND s.y > l.y - 10)", _n("dk_in", "n IS NULL")),
    """SELECT 'twice', 'failed', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""])


def _run(spark, sf_dir, root):
    maps = _region_map(spark, sf_dir)
    lines = materialize(_lines(spark, sf_dir))          # grouped once for all sources: the joins run once
    dk = dk_rows(spark, sf_dir, lines)
    national = dk.select(F.lit("AT").alias("geo"), F.lit("ICCS0101").alias("iccs"), F.lit("NR").alias("unit"),
                         F.substring("TID", 1, 4).alias("TIME_PERIOD"), F.col("INDHOLD").alias("OBS_VALUE"))
    sources = [("uk", uk_rows(spark, sf_dir, lines), catalogue.uk(maps, "u", PAIRS)),
               ("fr", fr_rows(spark, sf_dir, lines), catalogue.fr(maps, "u", PAIRS)),
               ("twice", national, catalogue.eurostat("AT")),      # many rows per key: refused whole
               ("dk", dk, catalogue.dk(maps, "u", PAIRS))]
    return run_registry(spark, sources, _some_regions(spark, sf_dir), root, as_of=AS_OF)


@register("registry_accounts", oracle=f"WITH {BASE_SQL}, {UK_SQL}, {FR_SQL}, {DK_SQL} {ACCOUNTS_SQL}")
def registry_accounts(spark, sf_dir):
    """What each source's run lost, changed and wrote, counted while
    its rows passed; a source that repeats its keys is refused."""
    return _run(spark, sf_dir, scratch_path(spark, "registry")).drop("error")


# ---- the table with snapshot commits -----------------------------------------------------------
@register("snapshot_upsert", oracle="""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_custkey % 8 AS part,
                  CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT o_orderkey, o_custkey, part, CASE WHEN part IN (1, 5) AND o_orderkey % 3 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
       y FROM o WHERE y < 1998 OR part IN (1, 5)""")
def snapshot_upsert(spark, sf_dir):
    """Orders before 1998 are committed; then a batch with changed and new
    rows for two of the eight partitions.  Read through the pointer."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.pmod("o_custkey", F.lit(8)).alias("part"), "o_orderstatus",
        F.year("o_orderdate").cast("int").alias("y"))
    root = scratch_path(spark, "orders_snapshots")
    upsert_snapshot(spark, root, o.filter("y < 1998"), ["o_orderkey"], ["part"], o.schema)
    changed = o.filter(F.col("part").isin(1, 5) & ((F.col("o_orderkey") % 3 == 0) | (F.col("y") >= 1998)))
    changed = changed.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "Z").otherwise(F.col("o_orderstatus")))
    upsert_snapshot(spark, root, changed, ["o_orderkey"], ["part"], o.schema)
    return read_snapshot(spark, root, o.schema)


@register("registry_table", oracle=f"""WITH {BASE_SQL}, {UK_SQL}, {FR_SQL}, {DK_SQL}
SELECT source_country, region_code, crime_category, period_start, count FROM uk
UNION ALL SELECT source_country, region_code, crime_category, period_start, count FROM fr
UNION ALL SELECT source_country, region_code, crime_category, period_start, count FROM dk""")
def registry_table(spark, sf_dir):
    """The canonical table after the run, read through its pointer."""
    root = scratch_path(spark, "registry")
    _run(spark, sf_dir, root)
    return read_snapshot(spark, root, CRIME_AGGREGATES).select(
        "source_country", "region_code", "crime_category", "period_start", "count")
