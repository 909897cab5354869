"""Incident records: hard-key merge, geocode join, precision, confidence,
stable id and the 23-column canonical projection.

Records carry an ``ordinal`` (file, line) so "first record wins" is
deterministic.  Group merges are aggregates (``min_by``/``max``/``min``),
combined map-side; only the merged ``sources`` list is assembled per
incident, and its length is the number of distinct source URLs of that one
incident.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.ids import hard_key, incident_id, py_text
from harmoniq.functions.urls import POLICE_PR_OUTLETS, confidence, distinct_domains, url_domain
from harmoniq.schema import INCIDENT_COLUMNS, SOURCE_STRUCT

DEFAULT_EXTRACTOR = "manual@prompt-v1"
# optional record fields that a finished incident keeps when supplied
SUPPLIED = ("region_code", "extracted_at", "extractor_version", "review_status", "last_reviewed_at")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def with_hard_key(df: DataFrame, out: str = "hard_key") -> DataFrame:
    """F12 over the canonical record columns; ``victim_fatal_present`` (when
    given) distinguishes an absent field ('0') from JSON null ('None')."""
    present = F.col("victim_fatal_present") if "victim_fatal_present" in df.columns else None
    from harmoniq.functions.ids import fatal_text
    return df.withColumn(out, hard_key("date_incident", "date_reported", "country", "city",
                                       "weapon", fatal_text("victim_fatal", present)))


def _non_empty(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def merge_hard(df: DataFrame, key: str = "hard_key", ordinal: str = "ordinal") -> DataFrame:
    """Collapse records sharing the hard key.

    First record (by ordinal) wins for plain fields; victim_count and
    victim_fatal take the max (absent = 0); date_reported the earliest
    non-empty; description and origin the first non-empty, each on its own;
    sources are unioned, unique by URL in first-seen order, URL-less dropped.
    Single-record groups pass through untouched."""
    cols = [c for c in df.columns if c != key]
    ordered = F.struct(F.col(ordinal))
    g = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min_by(F.struct(*cols), ordered).alias("__first"),
        F.max(F.coalesce(F.col("victim_count"), F.lit(0))).alias("__vc"),
        F.max(F.coalesce(F.col("victim_fatal"), F.lit(0))).alias("__vf"),
        F.min(F.when(_non_empty("date_reported"), F.col("date_reported"))).alias("__dr"),
        F.min_by("suspect_description_verbatim",
                 F.when(_non_empty("suspect_description_verbatim"), F.col(ordinal))).alias("__desc"),
        F.min_by("suspect_origin_as_reported",
                 F.when(_non_empty("suspect_origin_as_reported"), F.col(ordinal))).alias("__orig"),
    )
    merged_sources = merge_sources(df, key, ordinal)
    g = g.join(merged_sources, key, "left")
    multi = F.col("__n") > 1
    out = []
    for c in cols:
        first = F.col(f"__first.{c}")
        if c == "victim_count":
            e = F.when(multi, F.col("__vc")).otherwise(first)
        elif c == "victim_fatal":
            e = F.when(multi, F.col("__vf")).otherwise(first)
        elif c == "date_reported":
            e = F.when(multi, F.coalesce(F.col("__dr"), first)).otherwise(first)
        elif c == "suspect_description_verbatim":
            e = F.when(multi & ~(first.isNotNull() & (first != "")), F.coalesce(F.col("__desc"), first)).otherwise(first)
        elif c == "suspect_origin_as_reported":
            e = F.when(multi & ~(first.isNotNull() & (first != "")), F.coalesce(F.col("__orig"), first)).otherwise(first)
        elif c == "sources":
            e = F.when(multi, F.coalesce(F.col("__sources"), F.array().cast(df.schema["sources"].dataType))).otherwise(first)
        else:
            e = first
        out.append(e.alias(c))
    return g.select(F.col(key), *out, F.col("__n").alias("n_records"))


def merge_sources(df: DataFrame, key: str = "hard_key", ordinal: str = "ordinal") -> DataFrame:
    """Union of a group's sources, unique by URL, first-seen order."""
    s = (df.select(key, ordinal, F.posexplode("sources").alias("__pos", "__src"))
         .filter(F.col("__src.url").isNotNull() & (F.col("__src.url") != "")))
    first = (s.groupBy(key, F.col("__src.url").alias("__url"))
             .agg(F.min_by("__src", F.struct(ordinal, "__pos")).alias("__src"),
                  F.min(F.struct(ordinal, "__pos")).alias("__at")))
    return (first.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("__at", "__src"))).alias("__l"))
            .select(key, F.transform("__l", lambda x: x["__src"]).alias("__sources")))


def region_hint(df: DataFrame) -> Column:
    """Normalised hint: the record's region, else its state, else ''."""
    given = [F.nullif(F.col(c), F.lit("")) for c in ("region", "state") if c in df.columns]
    return F.lower(F.trim(F.coalesce(*given, F.lit(""))))


def geocode_join(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Left join to the geocode cache on (upper country, lower-trim
    city, lower-trim hint); a miss or an empty city gives NULLs."""
    c = cache.select(
        F.upper(F.col("country")).alias("__gc"),
        F.lower(F.trim(F.col("city"))).alias("__gcity"),
        F.lower(F.trim(F.coalesce(F.col("region_hint"), F.lit("")))).alias("__gh"),
        F.col("lat").cast("double").alias("geo_lat"), F.col("lon").cast("double").alias("geo_lon"),
        F.nullif(F.col("nuts_code"), F.lit("")).alias("geo_nuts"))
    hint = region_hint(df)
    city_ok = F.coalesce(F.col("city"), F.lit("")) != ""
    # records without a city never match; keeping them out of the join
    # stops them from forming one hot join key
    with_city, no_city = df.filter(city_ok), df.filter(~city_ok)
    j = with_city.join(c, (F.upper(F.coalesce(F.col("country"), F.lit(""))) == F.col("__gc"))
                       & (F.lower(F.trim(F.col("city"))) == F.col("__gcity"))
                       & (hint == F.col("__gh")), "left")
    j = j.drop("__gc", "__gcity", "__gh")
    return j.unionByName(no_city.select("*", *[F.lit(None).cast(t).alias(n) for n, t in
                                               (("geo_lat", "double"), ("geo_lon", "double"),
                                                ("geo_nuts", "string"))]))


def geocode_misses(df: DataFrame, cache: DataFrame) -> DataFrame:
    """J11 work list: distinct normalised (country, city, hint) keys of
    records with a city that the cache cannot answer (anti join)."""
    keys = df.filter(F.coalesce(F.col("city"), F.lit("")) != "").select(
        F.upper(F.coalesce(F.col("country"), F.lit(""))).alias("country"),
        F.lower(F.trim(F.col("city"))).alias("city"),
        region_hint(df).alias("region_hint")).distinct()
    have = cache.select(F.upper(F.col("country")).alias("country"), F.lower(F.trim(F.col("city"))).alias("city"),
                        F.lower(F.trim(F.coalesce(F.col("region_hint"), F.lit("")))).alias("region_hint"))
    return keys.join(have, ["country", "city", "region_hint"], "left_anti")


def location_precision(given, city, geo_lat, geo_lon) -> Column:
    """F16: 'exact' only if the geocoder found the place and the record says
    exact; else 'city' if a city is named; else 'region'."""
    return (F.when(_c(geo_lat).isNotNull() & _c(geo_lon).isNotNull() & (_c(given) == "exact"),
                   F.lit("exact"))
            .when(F.coalesce(_c(city), F.lit("")) != "", F.lit("city"))
            .otherwise(F.lit("region")))


def sources_text(df: DataFrame) -> Column:
    """the sources as JSON text, nulls kept.  Sources that were read with
    their own JSON (``raw``) are written as they came, unknown keys included."""
    kind = df.schema["sources"].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and "raw" in kind.elementType.names:
        joined = F.array_join(F.transform("sources", lambda s: s["raw"]), ",")
        return F.concat(F.lit("["), F.coalesce(joined, F.lit("")), F.lit("]"))
    return F.coalesce(F.to_json("sources", {"ignoreNullFields": "false"}), F.lit("[]"))


def finalize(records: DataFrame, cache: DataFrame, extracted_at, outlets=POLICE_PR_OUTLETS,
             extractor: str = DEFAULT_EXTRACTOR) -> DataFrame:
    """dedupe -> geocode -> precision -> confidence -> id -> defaults ->
    23 canonical columns (sources as JSON text only at this edge).

    What a record supplies wins: the defaults fill only absent or empty review
    fields, the geocoder only absent places.  A latitude given as JSON null
    asks for the geocoder's latitude, longitude and region together."""
    merged = merge_hard(with_hard_key(records))
    g = geocode_join(merged, cache)
    given = {c: F.col(f"{c}_present") if f"{c}_present" in g.columns else
             (F.col(c).isNotNull() if c in g.columns else F.lit(False)) for c in ("lat", "lon", "region_code")}
    place = {c: F.col(c) if c in g.columns else F.lit(None) for c in given}
    asked = given["lat"] & F.col("lat").isNull() & F.col("geo_lat").isNotNull()
    located = {c: F.when(given[c] & ~asked, place[c]).otherwise(F.col(geo))
               for c, geo in (("lat", "geo_lat"), ("lon", "geo_lon"), ("region_code", "geo_nuts"))}
    supplied = {c: F.nullif(F.col(c), F.lit("")) if c in g.columns else F.lit(None).cast("string") for c in SUPPLIED}
    urls = F.transform(F.coalesce(F.col("sources"), F.array()), lambda s: s["url"])
    present = {c: F.col(f"{c}_present") if f"{c}_present" in g.columns else None
               for c in ("date_incident", "country", "city", "weapon", "victim_fatal")}
    out = g.select(
        incident_id(py_text("date_incident", present["date_incident"]),
                    py_text("country", present["country"]), py_text("city", present["city"]),
                    py_text("weapon", present["weapon"]),
                    py_text("victim_fatal", present["victim_fatal"])).alias("incident_id"),
        "date_incident", "date_reported", "country",
        located["region_code"].cast("string").alias("region_code"),
        "city", located["lat"].alias("lat"), located["lon"].alias("lon"),
        location_precision("location_precision", "city", "geo_lat", "geo_lon").alias("location_precision"),
        "weapon", "victim_count", "victim_fatal", "victim_sex_summary", "victim_age_summary",
        "suspect_count", "suspect_description_verbatim", "suspect_origin_as_reported",
        sources_text(g).alias("sources_json"),
        confidence(distinct_domains(urls), outlets).alias("confidence"),
        F.coalesce(supplied["extracted_at"], F.lit(extracted_at).cast("string")).alias("extracted_at"),
        F.coalesce(supplied["extractor_version"], F.lit(extractor)).alias("extractor_version"),
        (F.col("last_reviewed_at") if "last_reviewed_at" in g.columns else F.lit(None).cast("string"))
        .alias("last_reviewed_at"),
        F.coalesce(supplied["review_status"], F.lit("unreviewed")).alias("review_status"),
    )
    return out.select(*INCIDENT_COLUMNS)


def domain_confidence(df: DataFrame, group: str, url: str, outlets=POLICE_PR_OUTLETS) -> DataFrame:
    """A14 + F15 as pure aggregates: distinct domains per group and whether
    any is a listed outlet, without collecting a group's URLs."""
    from harmoniq.functions.urls import is_listed_outlet
    d = df.select(group, url_domain(F.coalesce(F.col(url), F.lit(""))).alias("domain")).distinct()
    ok = F.col("domain") != ""
    g = d.groupBy(group).agg(
        F.count(F.when(ok, F.lit(1))).alias("n_domains"),
        F.coalesce(F.max(F.when(ok, is_listed_outlet("domain", outlets).cast("int"))),
                   F.lit(0)).alias("__listed"))
    return g.select(group, "n_domains",
                    F.when(F.col("__listed") == 1, F.lit("HIGH"))
                    .when(F.col("n_domains") >= 2, F.lit("MEDIUM"))
                    .otherwise(F.lit("LOW")).alias("confidence"))


# S11 + P21: envelopes -> incident records ---------------------------------------------
_TEXT_FIELDS = ("date_incident", "date_reported", "country", "city", "weapon", "victim_sex_summary",
                "victim_age_summary", "suspect_description_verbatim", "suspect_origin_as_reported",
                "location_precision", "region", "state", *SUPPLIED)
_INT_FIELDS = ("victim_count", "victim_fatal", "suspect_count")
_FLAGGED = ("date_incident", "country", "city", "weapon", "victim_fatal", "lat", "lon", "region_code")


def envelope_records(env: DataFrame) -> DataFrame:
    """Envelopes read as VARIANT (``file``, ``block``, ``line_no``, ``v``) -> records.
    Keeps envelopes that are extracted and carry a non-empty incident;
    ``<f>_present`` flags tell an absent id or place field from a JSON null one;
    ``ordinal`` = (file, line) orders first-wins merges."""
    inc = F.try_variant_get("v", "$.incident", "variant")
    keep = (F.coalesce(F.try_variant_get("v", "$.extracted", "boolean"), F.lit(False))
            & inc.isNotNull() & ~F.to_json(inc).isin("null", "{}"))
    e = env.filter(keep)
    cols = [F.struct(F.col("file"), F.col("block"), F.col("line_no")).alias("ordinal")]
    for f in _TEXT_FIELDS:
        cols.append(F.try_variant_get("v", f"$.incident.{f}", "string").alias(f))
    for f in _INT_FIELDS:
        cols.append(F.try_variant_get("v", f"$.incident.{f}", "bigint").alias(f))
    for f in ("lat", "lon"):
        cols.append(F.try_variant_get("v", f"$.incident.{f}", "double").alias(f))
    each = F.try_variant_get("v", "$.incident.sources", "array<variant>")
    cols.append(F.transform(each, lambda s: F.struct(
        *[F.try_variant_get(s, f"$.{f.name}", "string").alias(f.name) for f in SOURCE_STRUCT.fields],
        F.to_json(s).alias("raw"))).alias("sources"))
    for f in _FLAGGED:
        cols.append(F.try_variant_get("v", f"$.incident.{f}", "variant").isNotNull().alias(f"{f}_present"))
    return e.select(*cols)


def upsert_incidents(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """J7 on incident_id.  Two hard-key groups can share one stable id (the
    hard key falls back to date_reported, the id does not), so duplicate ids
    inside the batch are collapsed first: the record with more source text,
    then the later extraction, wins."""
    from harmoniq.operators.upsert import upsert
    ranked = incoming.withColumn("__src_len", F.length(F.coalesce(F.col("sources_json"), F.lit(""))))
    out = upsert(existing.withColumn("__src_len", F.lit(0)), ranked, ["incident_id"],
                 order=["__src_len", "extracted_at", "sources_json"])
    return out.drop("__src_len")
