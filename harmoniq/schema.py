"""Canonical tables: column order, Spark types and domain rules."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the published data model) ---------------------
CRIME_CATEGORIES = (
    "homicide", "attempted_homicide", "knife_offence", "firearm_offence",
    "sexual_assault", "robbery_violent", "assault_serious", "violent_total",
)
SUSPECT_DIMS = ("total", "national", "foreign", "by_origin_country", "unknown")
PERIOD_TYPES = ("month", "quarter", "year")
# Parts summed into a derived violent_total when a source lacks the umbrella.
DERIVED_PARTS = ("homicide", "attempted_homicide", "assault_serious",
                 "sexual_assault", "robbery_violent")
# Natural key of crime_aggregates; NULL and '' are the same key value.
AGGREGATE_KEY = ("source_country", "period_start", "region_code",
                 "crime_category", "suspect_dim", "suspect_dim_value")
# --- end fixed values -------------------------------------------------------

CRIME_AGGREGATES = T.StructType([
    T.StructField("source_country", T.StringType(), False),
    T.StructField("source_authority", T.StringType(), False),
    T.StructField("source_url", T.StringType(), False),
    T.StructField("source_file_hash", T.StringType(), False),
    T.StructField("retrieved_at", T.TimestampNTZType(), False),
    T.StructField("period_start", T.DateType(), False),
    T.StructField("period_end", T.DateType(), False),
    T.StructField("period_type", T.StringType(), False),
    T.StructField("region_code", T.StringType(), False),
    T.StructField("region_level", T.IntegerType(), False),
    T.StructField("crime_category", T.StringType(), False),
    T.StructField("crime_category_native", T.StringType(), False),
    T.StructField("suspect_dim", T.StringType(), False),
    T.StructField("suspect_dim_value", T.StringType(), True),
    T.StructField("count", T.LongType(), False),
    T.StructField("denominator_population", T.LongType(), True),
    T.StructField("denominator_source", T.StringType(), True),
    T.StructField("rate_per_100k", T.DoubleType(), True),
    T.StructField("notes", T.StringType(), True),
])

SOURCE_STRUCT = T.StructType([
    T.StructField("url", T.StringType(), True),
    T.StructField("outlet", T.StringType(), True),
    T.StructField("published_at", T.StringType(), True),
    T.StructField("quote_snippet", T.StringType(), True),
])

INCIDENT_FIELDS = T.StructType([
    T.StructField("date_incident", T.StringType(), True),
    T.StructField("date_reported", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("weapon", T.StringType(), True),
    T.StructField("victim_count", T.LongType(), True),
    T.StructField("victim_fatal", T.LongType(), True),
    T.StructField("victim_sex_summary", T.StringType(), True),
    T.StructField("victim_age_summary", T.StringType(), True),
    T.StructField("suspect_count", T.LongType(), True),
    T.StructField("suspect_description_verbatim", T.StringType(), True),
    T.StructField("suspect_origin_as_reported", T.StringType(), True),
    T.StructField("location_precision", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("sources", T.ArrayType(SOURCE_STRUCT), True),
])

ENVELOPE = T.StructType([
    T.StructField("extracted", T.BooleanType(), True),
    T.StructField("skip_reason", T.StringType(), True),
    T.StructField("incident", INCIDENT_FIELDS, True),
])

INCIDENT_COLUMNS = (
    "incident_id", "date_incident", "date_reported", "country",
    "region_code", "city", "lat", "lon", "location_precision",
    "weapon", "victim_count", "victim_fatal",
    "victim_sex_summary", "victim_age_summary",
    "suspect_count", "suspect_description_verbatim", "suspect_origin_as_reported",
    "sources_json", "confidence",
    "extracted_at", "extractor_version", "last_reviewed_at", "review_status",
)

NUTS_REGIONS = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("name_en", T.StringType(), True),
    T.StructField("name_native", T.StringType(), True),
    T.StructField("parent_code", T.StringType(), True),
    T.StructField("level", T.IntegerType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("population_latest", T.LongType(), True),
    T.StructField("area_km2", T.DoubleType(), True),
    T.StructField("centroid_lat", T.DoubleType(), True),
    T.StructField("centroid_lon", T.DoubleType(), True),
])

ARTICLE = T.StructType([
    T.StructField("url", T.StringType(), True),
    T.StructField("outlet", T.StringType(), True),
    T.StructField("published_at", T.StringType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("lead", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
])
