"""Intake/export bindings: S11/S12 JSON Lines envelopes (null vs absent
identity), S13/S14 feed records, S15/F19 content manifest, S16/J11/F16
geocode cache with schema evolution, S19/S20 GeoJSON exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.ids import INCIDENT_NAMESPACE, content_hash, incident_id, py_text
from harmoniq.operators.incidents import geocode_join, location_precision
from harmoniq.plans import register
from harmoniq.plans.common import SQL_REGION_DIM, nation_code, region_dim, table, with_ctes
from harmoniq.plans.incidents_q import FINALIZED_SQL, finalized
from harmoniq.plans.readers_q import write_region_geojson
from harmoniq.session import materialize, scratch_path
from harmoniq.sources import exports as X
from harmoniq.sources import files as S

_NS_HEX = INCIDENT_NAMESPACE.replace("-", "")


def _uuid_sql(name: str) -> str:
    h = f"sha1(unhex('{_NS_HEX}') || encode({name}))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || "
            f"substr({h}, 21, 12)")


# ---- S11 S12 P21 F18 F13: JSON Lines envelopes ---------------------------------------------------
FATAL_TEXT_SQL = ("CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN 'None' "
                  "ELSE CASE WHEN value >= 200 THEN '1' ELSE '0' END END")
NAME_SQL = ("CAST(CAST(ts AS DATE) AS VARCHAR) || '|' || upper(substr(event_type, 1, 2)) || '|' || "
            "'User' || CAST(user_id AS VARCHAR) || '|' || "
            "CASE WHEN value < 100 THEN 'knife' WHEN value < 300 THEN 'firearm' ELSE 'other' END || '|' || "
            f"({FATAL_TEXT_SQL})")


@register("jsonl_roundtrip", oracle=f"""
SELECT event_id, {FATAL_TEXT_SQL} AS victim_fatal_text, {_uuid_sql(f"({NAME_SQL})")} AS incident_id
FROM events WHERE event_type <> 'error'""")
def jsonl_roundtrip(spark, sf_dir):
    """Envelopes written as JSON Lines: 'click' incidents lack victim_fatal,
    'view' incidents carry it as JSON null, 'error' envelopes are not
    extracted, 'purchase' lines are followed by a blank line.  Read back as
    VARIANT, the absent and the null field give different stable ids."""
    e = table(spark, sf_dir, "events")
    fatal = F.when(F.col("event_type").isin("click", "view"), F.lit(None)).otherwise(
        F.when(F.col("value") >= 200, 1).otherwise(0))
    inc = F.to_json(F.struct(
        F.col("event_id").alias("ordinal"), F.to_date("ts").cast("string").alias("date_incident"),
        F.upper(F.substring("event_type", 1, 2)).alias("country"),
        F.concat(F.lit("User"), F.col("user_id").cast("string")).alias("city"),
        F.when(F.col("value") < 100, "knife").when(F.col("value") < 300, "firearm").otherwise("other").alias("weapon"),
        fatal.alias("victim_fatal")))
    inc = F.when(F.col("event_type") == "view", F.regexp_replace(inc, r"^\{", '{"victim_fatal":null,')).otherwise(inc)
    line = F.concat(F.lit('{"extracted":'),
                    F.when(F.col("event_type") == "error", F.lit("false")).otherwise(F.lit("true")),
                    F.lit(',"skip_reason":null,"incident":'), inc, F.lit("}"))
    lines = e.select(F.explode(F.when(F.col("event_type") == "purchase", F.array(line, F.lit("")))
                               .otherwise(F.array(line))).alias("value"))
    path = scratch_path(spark, "outbox")
    lines.write.text(path)
    env = S.read_jsonl_variant(spark, path)
    inc_v = F.try_variant_get("v", "$.incident", "variant")
    env = env.filter(F.coalesce(F.try_variant_get("v", "$.extracted", "boolean"), F.lit(False))
                     & inc_v.isNotNull() & ~F.to_json(inc_v).isin("null", "{}"))         # P21
    fields = {k: S.variant_field("v", f"$.incident.{k}") for k in
              ("date_incident", "country", "city", "weapon", "victim_fatal")}
    texts = {k: py_text(val, present) for k, (val, present) in fields.items()}
    return env.select(
        F.try_variant_get("v", "$.incident.ordinal", "bigint").alias("event_id"),
        texts["victim_fatal"].alias("victim_fatal_text"),
        incident_id(texts["date_incident"], texts["country"], texts["city"], texts["weapon"],
                    texts["victim_fatal"]).alias("incident_id"))


# ---- S13 F10: article-list payloads -> article records ----------------------------------------
LANG_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
LANG_SQL = "regexp_extract(url, '^[^/]*//[^/]*/([a-z]+)/', 1)"
HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)', 1))"
TITLE_SQL = "regexp_extract(html, '<title>(.*?)</title>', 1)"


@register("feed_records", oracle=f"""
SELECT url, CASE WHEN page_id % 7 < 2 THEN upper({LANG_SQL}) ELSE {HOST_SQL} END AS outlet,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + page_id * INTERVAL 1 HOUR, '%Y%m%dT%H%M%SZ') AS published_at,
       CASE WHEN page_id % 5 <> 0 THEN lower(CASE {LANG_SQL} {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_NAMES.items())} END) END AS language,
       {TITLE_SQL} AS title, '' AS lead, 'gdelt' AS source, upper({LANG_SQL}) AS country
FROM pages""")
def feed_records(spark, sf_dir):
    """Landed payloads hold as many articles as one request returns; some have
    no domain (missing or empty), some no language."""
    return X.gdelt_articles(landed_payloads(spark, sf_dir), F.col("country"))


# fixed value: articles of one request
REQUEST_CAP = 250


def landed_payloads(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", r"^[^/]*//[^/]*/([a-z]+)/", 1)
    names = F.create_map(*[x for k, v in LANG_NAMES.items() for x in (F.lit(k), F.lit(v))])
    seen = F.timestamp_add("HOUR", F.col("page_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1))
    art = F.struct(F.col("url"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
                   F.date_format(seen, "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
                   F.when(F.col("page_id") % 7 == 0, F.lit(None)).when(F.col("page_id") % 7 == 1, "").otherwise(host).alias("domain"),
                   F.when(F.col("page_id") % 5 == 0, "").otherwise(F.element_at(names, lang)).alias("language"),
                   F.upper(lang).alias("sourcecountry"))
    docs = (p.groupBy(F.upper(lang).alias("country"), F.floor(F.col("page_id") / REQUEST_CAP).alias("request"))
            .agg(F.collect_list(art).alias("articles")).drop("request"))
    path = scratch_path(spark, "gdelt")
    X.write_jsonl(docs.repartition("country"), path)             # S12: nulls and empty texts stay apart
    country = T.StructType([*X.GDELT_DOC.fields, T.StructField("country", T.StringType())])
    return spark.read.schema(country).json(path)


@register("rss_records", oracle=f"""
SELECT url, {HOST_SQL} AS outlet,
       CASE page_id % 6
         WHEN 0 THEN strftime(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') || 'T09:30:00+00:00'
         WHEN 1 THEN strftime(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') || 'T10:30:00+00:00'
         WHEN 2 THEN strftime(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') || 'T00:00:00+00:00'
         WHEN 3 THEN strftime(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') || 'T08:30:00+00:00'
         WHEN 4 THEN strftime(DATE '2024-02-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') || 'T23:05:00+00:00' END AS published_at,
       'en' AS language, {TITLE_SQL} AS title,
       left(regexp_replace(regexp_replace(CASE WHEN starts_with(url, 'https://') THEN html ELSE '<p>' || url || '</p>' END,
                                          '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), 1500) AS lead,
       'rss' AS source, upper({LANG_SQL}) AS country
FROM pages WHERE position('spam-farm' IN url) = 0""")
def rss_records(spark, sf_dir):
    """Dates as feeds write them: with week day and offset, with a named zone,
    a day alone, ISO with an offset, none but that of the update, junk."""
    p = table(spark, sf_dir, "pages")
    k, shift = F.col("page_id") % 6, (F.col("page_id") % 28).cast("int")
    day, later = F.date_add(F.lit("2024-01-01").cast("date"), shift), F.date_add(F.lit("2024-02-01").cast("date"), shift)
    spelled = F.date_format(day, "EEE, dd MMM yyyy")
    published = F.when(k == 0, F.concat(spelled, F.lit(" 10:30:00 +0100"))).when(k == 1, F.concat(spelled, F.lit(" 10:30 GMT"))) \
        .when(k == 2, day.cast("string")).when(k == 3, F.concat(day.cast("string"), F.lit("T10:30:00+02:00"))) \
        .when(k == 4, "yesterday")
    entries = p.select(
        F.when(~F.col("url").contains("spam-farm"), F.col("url")).alias("link"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.when(F.col("url").startswith("https://"), F.col("html")).alias("summary"),
        F.concat(F.lit("<p>"), F.col("url"), F.lit("</p>")).alias("description"), published.alias("published"),
        F.when(k == 4, F.concat(later.cast("string"), F.lit(" 23:05:00"))).alias("updated"),
        F.upper(F.regexp_extract("url", r"^[^/]*//[^/]*/([a-z]+)/", 1)).alias("country"),
        F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1)).alias("outlet"))
    return X.rss_articles(entries, "EN", 1500)


# ---- S15 F19: content hashes against a manifest ----------------------------------------------
@register("content_manifest", oracle="""
SELECT doc_id, sha256(text) AS sha256 FROM documents
WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'en')""")
def content_manifest(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", content_hash("text").alias("sha256"))
    manifest = d.filter(F.col("lang") == "en").select("sha256")
    return S.new_content(d.drop("lang"), manifest).select("doc_id", "sha256")


# ---- S16 J11 F16 F17: geocode cache with an old part lacking region_hint ----------------------
@register("geocode_join", oracle="""
SELECT o.o_orderkey,
       CASE WHEN c.c_mktsegment <> 'MACHINERY' THEN c.c_acctbal / 100 END AS lat,
       CASE WHEN c.c_mktsegment <> 'MACHINERY' THEN CAST(c.c_nationkey AS DOUBLE) END AS lon,
       CASE WHEN c.c_mktsegment <> 'MACHINERY'
            THEN 'R' || CAST(n.n_regionkey AS VARCHAR) || chr(65 + n.n_nationkey) END AS region_code,
       CASE WHEN c.c_mktsegment <> 'MACHINERY' AND o.o_orderstatus = 'F' THEN 'exact' ELSE 'city' END
         AS location_precision
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def geocode_join_q(spark, sf_dir):
    cache, recs = _geocode_inputs(spark, sf_dir)
    g = geocode_join(recs, cache)
    return g.select("o_orderkey", F.col("geo_lat").alias("lat"), F.col("geo_lon").alias("lon"),
                    F.col("geo_nuts").alias("region_code"),
                    location_precision("given", "city", "geo_lat", "geo_lon").alias("location_precision"))


@register("geocode_misses", oracle="""
SELECT DISTINCT 'R' || CAST(n.n_regionkey AS VARCHAR) AS country, lower(c.c_name) AS city, '' AS region_hint
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE c.c_mktsegment = 'MACHINERY'""")
def geocode_misses_q(spark, sf_dir):
    from harmoniq.operators.incidents import geocode_misses
    cache, recs = _geocode_inputs(spark, sf_dir)
    return geocode_misses(recs, cache)


@register("geocode_append", oracle="""
WITH r AS (SELECT o.o_orderkey, c.c_custkey, c.c_nationkey, n.n_regionkey, c.c_acctbal, c.c_mktsegment
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey)
SELECT o_orderkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey % 90 AS DOUBLE) END
                        ELSE c_acctbal / 100 END AS lat,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + c_nationkey)
            WHEN c_custkey % 10 <> 0 THEN 'R' || CAST(n_regionkey AS VARCHAR) END AS region_code,
       CAST(0 AS BIGINT) AS misses_left, CAST(4 AS BIGINT) AS entries
FROM r""")
def geocode_append(spark, sf_dir):
    """The old cache files become the log's first entry; the misses are
    resolved (some are not found, first with a wrong place, then again) and
    appended; no miss is left, also after the log is compacted."""
    from harmoniq.operators.geocode_cache import append_resolved, compact, read_cache
    from harmoniq.operators.incidents import geocode_misses
    from harmoniq.operators.snapshots import _partitions
    old, recs = _geocode_inputs(spark, sf_dir)
    root = scratch_path(spark, "geocode_log")
    append_resolved(spark, root, old)
    found = materialize(geocode_misses(recs, read_cache(spark, root)))
    for wrong in (True, False):
        key = F.regexp_extract("city", r"([0-9]+)$", 1).cast("bigint")
        lost = key % 10 == 0
        place = F.lit(0.0) if wrong else (key % 90).cast("double")
        answers = found.select("country", "city", "region_hint", F.when(~lost, place).alias("lat"),
                               F.when(~lost, F.lit(1.0)).alias("lon"), F.when(~lost, F.col("country")).alias("nuts_code"))
        append_resolved(spark, root, answers)
    left = geocode_misses(recs, read_cache(spark, root)).count()
    entries = compact(spark, root)
    if len(_partitions(spark, root, entries)) != 1:
        raise RuntimeError("compaction leaves one entry")
    g = geocode_join(recs, read_cache(spark, root))
    return g.select("o_orderkey", F.col("geo_lat").alias("lat"), F.col("geo_nuts").alias("region_code"),
                    F.lit(left).cast("bigint").alias("misses_left"), F.lit(entries).cast("bigint").alias("entries"))


def _geocode_inputs(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    base = cn.select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"),
                     F.col("c_name").alias("city"), F.lower("c_mktsegment").alias("region_hint"),
                     (F.col("c_acctbal") / 100).cast("string").alias("lat"),
                     F.col("c_nationkey").cast("double").cast("string").alias("lon"),
                     nation_code("n_regionkey", "n_nationkey").alias("nuts_code"), "c_mktsegment")
    root = scratch_path(spark, "geocode_cache")
    old_cols = ["country", "city", "lat", "lon", "nuts_code"]
    new_cols = ["country", "city", "region_hint", "lat", "lon", "nuts_code"]
    base.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).select(*old_cols) \
        .write.option("header", True).csv(f"{root}/old")
    base.filter(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD")).select(*new_cols) \
        .write.option("header", True).csv(f"{root}/new")
    cache = S.read_evolving_csv(spark, [(f"{root}/old", old_cols), (f"{root}/new", new_cols)])
    o = table(spark, sf_dir, "orders")
    recs = (o.join(cn, o.o_custkey == cn.c_custkey)
            .select("o_orderkey",
                    F.lower(F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))).alias("country"),
                    F.concat(F.lit("  "), F.col("c_name")).alias("city"),
                    F.when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"),
                           F.concat(F.upper("c_mktsegment"), F.lit(" "))).alias("region"),
                    F.when(F.col("o_orderstatus") == "F", "exact").otherwise("city").alias("given")))
    return cache, recs


# ---- S19 S20: GeoJSON exports (JSON text; checked structurally in tests) ------------------------
@register("points_export")
def points_export(spark, sf_dir):
    d = region_dim(spark, sf_dir)
    feats = X.point_features(d, "centroid_lon", "centroid_lat", ["code", "name_en", "population_latest"])
    return feats


@register("geojson_export")
def geojson_export(spark, sf_dir):
    path = write_region_geojson(spark, sf_dir)
    f = S.read_geojson(spark, f"{path}/*")
    slim = f.select(F.col("properties")["NUTS_ID"].alias("code"),
                    F.col("properties")["CNTR_CODE"].alias("country"), "geometry")
    features = X.polygon_features(slim, "geometry", ["code"]).withColumn(
        "code", F.get_json_object("feature", "$.properties.code"))
    return X.document_parts(features.withColumn("country", F.substring("code", 1, 2)), "country", ["code"], "feature")


# ---- S19: incidents as GeoJSON, parsed back -----------------------------------------------------
INCIDENT_FEATURE = ("struct<type:string, properties:struct<incident_id:string, city:string, weapon:string, "
                    "victim_count:bigint, suspect_origin_as_reported:string, date_incident:string, confidence:string, "
                    "sources:string>, geometry:struct<type:string, coordinates:array<double>>>")


def _incident_points(spark, sf_dir):
    done = finalized(spark, sf_dir)
    bad = F.when(F.col("weapon") == "firearm", "not json").when(F.col("weapon") == "other", "").otherwise(F.col("sources_json"))
    return X.incident_features(done.withColumn("sources_json", bad))


@register("incident_points", oracle=f"""
WITH f AS (SELECT * FROM ({FINALIZED_SQL}) WHERE lat IS NOT NULL AND lon IS NOT NULL)
SELECT incident_id, city, weapon, victim_count, CAST(NULL AS VARCHAR) AS suspect_origin_as_reported, date_incident, confidence,
       CASE WHEN weapon = 'knife' THEN CAST(json_array_length(sources_json) AS BIGINT) ELSE 0 END AS n_sources,
       CASE WHEN weapon = 'knife' THEN json_extract_string(sources_json, '$[0].url') END AS first_url,
       weapon = 'knife' AS snippet_is_null, date_incident IS NULL AS has_null_date, lat, lon
FROM f""")
def incident_points(spark, sf_dir):
    """Located incidents as Features: 15 properties with their nulls; some rows
    hold bad or empty source texts, which become empty lists."""
    f = _incident_points(spark, sf_dir).select("feature", F.from_json("feature", INCIDENT_FEATURE).alias("f"))
    p = F.col("f.properties")
    sources = F.parse_json(p["sources"])
    return f.select(p["incident_id"].alias("incident_id"), p["city"].alias("city"), p["weapon"].alias("weapon"),
                    p["victim_count"].alias("victim_count"), p["suspect_origin_as_reported"].alias("suspect_origin_as_reported"),
                    p["date_incident"].alias("date_incident"), p["confidence"].alias("confidence"),
                    F.size(F.variant_get(sources, "$", "array<variant>")).cast("bigint").alias("n_sources"),
                    F.try_variant_get(sources, "$[0].url", "string").alias("first_url"),
                    F.col("feature").contains('"quote_snippet":null').alias("snippet_is_null"),
                    F.col("feature").contains('"date_incident":null').alias("has_null_date"),
                    F.col("f.geometry.coordinates")[1].alias("lat"), F.col("f.geometry.coordinates")[0].alias("lon"))


# ---- S19 / S20 checked by parsing the produced GeoJSON back ----------------------------------
POINT_FEATURE = "struct<type:string, properties:struct<code:string, name_en:string, population_latest:bigint>, " \
                "geometry:struct<type:string, coordinates:array<double>>>"


@register("points_export_parsed", oracle=with_ctes(SQL_REGION_DIM, """
SELECT code, name_en, population_latest, 'Point' AS geometry_type,
       CAST(centroid_lon AS DOUBLE) AS lon, CAST(centroid_lat AS DOUBLE) AS lat
FROM rdim WHERE centroid_lat IS NOT NULL AND centroid_lon IS NOT NULL"""))
def points_export_parsed(spark, sf_dir):
    f = points_export(spark, sf_dir).select(F.from_json("feature", POINT_FEATURE).alias("f"))
    return f.select(F.col("f.properties.code").alias("code"), F.col("f.properties.name_en").alias("name_en"),
                    F.col("f.properties.population_latest").alias("population_latest"),
                    F.col("f.geometry.type").alias("geometry_type"),
                    F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"))


FEATURE = "struct<type:string, properties:struct<code:string>, geometry:string>"


@register("geojson_export_parsed", oracle="""
SELECT 'R' || CAST(n_regionkey AS VARCHAR) AS country,
       'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) AS code,
       CASE WHEN n_regionkey IN (1, 3) THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type
FROM nation""")
def geojson_export_parsed(spark, sf_dir):
    f = X.part_elements(geojson_export(spark, sf_dir), FEATURE)
    return f.select("country", F.col("element.properties.code").alias("code"),
                    F.get_json_object("element.geometry", "$.type").alias("geometry_type"))


# ---- P19 + P20 with the language-name map on feed records -------------------------------------
# fixed values: feed language names -> keyword-list codes; demo keywords over invented titles
LANGUAGE_NAMES = {"english": "en", "french": "fr", "german": "de", "spanish": "es"}
TITLE_KEYWORDS = {"en": (["the", "ble"], ["thhewh"]), "fr": (["eaux"], ["zzz"]),
                  "de": (["en"], ["zzz"]), "es": (["ón"], ["zzz"])}


def _title_filter_sql():
    import re
    cases = " ".join(
        f"WHEN lk = '{lg}' THEN NOT regexp_matches(title, '{'|'.join(re.escape(w) for w in neg)}', 'i') "
        f"AND regexp_matches(title, '{'|'.join(re.escape(w) for w in pos)}', 'i')"
        for lg, (pos, neg) in TITLE_KEYWORDS.items())
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_NAMES.items())
    return names, cases


@register("feed_keyword_filter", oracle=f"""
WITH a AS (
  SELECT url, {TITLE_SQL} AS title,
         CASE WHEN page_id % 5 <> 0 THEN
           lower(CASE {LANG_SQL} {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_NAMES.items())} END) END AS language
  FROM pages
),
k AS (
  SELECT url, title,
         COALESCE(CASE split_part(COALESCE(NULLIF(language, ''), 'en'), '-', 1) {_title_filter_sql()[0]} END,
                  split_part(COALESCE(NULLIF(language, ''), 'en'), '-', 1)) AS lk
  FROM a
)
SELECT url, lk AS lang FROM k WHERE CASE {_title_filter_sql()[1]} ELSE false END""")
def feed_keyword_filter(spark, sf_dir):
    """Feed records name their language ('english'); the map turns names
    into keyword-list codes before the filter (without it every such record
    would be rejected as an unknown language)."""
    from harmoniq.functions.urls import lang_key
    from harmoniq.operators.articles import keyword_filter
    art = feed_records(spark, sf_dir).select("url", "title", lang_key("language", LANGUAGE_NAMES).alias("lang"))
    return keyword_filter(art, "title", "lang", TITLE_KEYWORDS).select("url", "lang")
