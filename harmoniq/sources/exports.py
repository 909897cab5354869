"""Sinks and export shapes: JSON Lines, nested JSON, GeoJSON points and
polygons, typed empty outputs, feed payload -> article records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.text import first_non_empty, strip_html
from harmoniq.schema import SOURCE_STRUCT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# S12 ----------------------------------------------------------------------------------
def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line; non-ASCII kept as is (UTF-8), nulls written
    as null, so an empty field and a missing one stay apart."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


# S19 -----------------------------------------------------------------------------------
KEEP_NULLS = {"ignoreNullFields": "false"}


def parsed_sources(sources_json) -> Column:
    """Any JSON text as VARIANT; empty, missing or bad JSON is an empty list."""
    text = F.nullif(_c(sources_json), F.lit(""))
    return F.coalesce(F.try_parse_json(text), F.parse_json(F.lit("[]")))


def point_features(df: DataFrame, lon: str, lat: str, props: list[str],
                   sources_json: str | None = None) -> DataFrame:
    """GeoJSON Feature per located row (P23: rows without coordinates are
    dropped); properties keep their nulls; ``sources_json`` is parsed back,
    bad JSON -> []."""
    located = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    p = [F.col(c) for c in props]
    if sources_json:
        p.append(parsed_sources(sources_json).alias("sources"))
    feat = F.struct(F.lit("Feature").alias("type"), F.struct(*p).alias("properties"),
                    F.struct(F.lit("Point").alias("type"),
                             F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"))
                    .alias("geometry"))
    return located.select(F.to_json(feat, KEEP_NULLS).alias("feature"))


# the published incident properties, in their order; the sources follow
INCIDENT_PROPERTIES = ["incident_id", "country", "city", "lat", "lon", "location_precision", "weapon", "victim_count",
                       "victim_fatal", "suspect_description_verbatim", "suspect_origin_as_reported", "confidence",
                       "date_incident", "date_reported"]


def incident_features(incidents: DataFrame) -> DataFrame:
    """The incidents table -> one Feature per located incident."""
    dated = incidents.withColumns({c: F.col(c).cast("string") for c in ("date_incident", "date_reported")})
    return point_features(dated, "lon", "lat", INCIDENT_PROPERTIES, "sources_json")


# S20 ------------------------------------------------------------------------------------
def polygon_features(df: DataFrame, geometry: str, props: list[str]) -> DataFrame:
    """GeoJSON Feature per region with slim properties; the geometry JSON
    text is passed through untouched."""
    pj = F.to_json(F.struct(*[F.col(c) for c in props]))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), pj,
                              F.lit(',"geometry":'), F.col(geometry), F.lit("}")).alias("feature"))


PART_BYTES = 8 << 20


def document_parts(elements: DataFrame, group: str, order: list[str], element: str,
                   part_bytes: int = PART_BYTES) -> DataFrame:
    """The ordered JSON elements of each group as parts of
    bounded size: (group, part, n, text), ``text`` holding elements joined by
    commas.  The parts of a group in order, joined by commas, are its document;
    no group is ever one row or one task: rows are dealt out by ranges of (group,
    order) and cut where a part is full (a longer element is a part of its own)."""
    from pyspark.sql import Window

    from harmoniq.session import materialize
    rows = elements.select(F.col(group).alias("g"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)],
                           F.col(element).alias("e"))
    by = ["g", *[f"o{k}" for k in range(len(order))], "e"]
    placed = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                         .select("g", "e", F.monotonically_increasing_id().alias("at")))
    placed = placed.withColumn("range", F.shiftright("at", 33))
    upto = Window.partitionBy("range", "g").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    size = F.octet_length("e") + 1
    cut = placed.withColumn("sub", F.floor((F.sum(size).over(upto) - size) / part_bytes))
    parts = cut.groupBy("g", "range", "sub").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "e"))), lambda r: r["e"]), ",").alias("text"),
        F.count(F.lit(1)).alias("n"))
    parts = materialize(parts)
    # parts are numbered by rows without their texts
    number = F.row_number().over(Window.partitionBy("g").orderBy("range", "sub"))
    numbers = parts.select(F.col("g").alias("__g"), F.col("range").alias("__r"), F.col("sub").alias("__s"), number.alias("part"))
    same = F.col("g").eqNullSafe(F.col("__g")) & (F.col("range") == F.col("__r")) & (F.col("sub") == F.col("__s"))
    return parts.join(numbers, same).select(F.col("g").alias(group), "part", "n", "text")


def document_index(parts: DataFrame, group: str) -> DataFrame:
    """What a reader needs to put documents together: parts and elements of each group."""
    return parts.groupBy(group).agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("elements"))


def write_documents(spark: SparkSession, parts: DataFrame, group: str, path: str) -> None:
    """One text line per part, in a folder per group, and the index as JSON
    Lines beside them."""
    parts.select(group, F.to_json(F.struct("part", "n", "text")).alias("value")).write.partitionBy(group).text(f"{path}/parts")
    write_jsonl(document_index(parts, group), f"{path}/index")


def read_documents(spark: SparkSession, path: str, group: str) -> DataFrame:
    """The written parts: (group, part, n, text); a part that the index counts
    and the folder lacks is an error."""
    kind = T.StructType([T.StructField("value", T.StringType()), T.StructField(group, T.StringType())])
    part = F.from_json("value", "struct<part:int, n:bigint, text:string>")
    parts = spark.read.schema(kind).text(f"{path}/parts").select(group, part.alias("p")).select(group, "p.*")
    told = spark.read.schema(f"`{group}` string, parts bigint, elements bigint").json(f"{path}/index")
    found = document_index(parts, group).select(F.col(group).alias("__g"), F.col("parts").alias("__p"), F.col("elements").alias("__e"))
    lost = told.join(found, F.col(group).eqNullSafe(F.col("__g")), "left").filter(
        ~(F.col("parts").eqNullSafe(F.col("__p")) & F.col("elements").eqNullSafe(F.col("__e"))))
    if not lost.isEmpty():
        raise ValueError(f"{path}: parts are missing")
    return parts


def part_elements(parts: DataFrame, kind: str | T.DataType) -> DataFrame:
    """A10: one row per element again, with its group and part."""
    kind = kind.simpleString() if isinstance(kind, T.DataType) else kind
    array = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), f"array<{kind}>")
    return parts.withColumn("element", F.explode(array)).drop("text")


def feature_collections(features: DataFrame, group: str) -> DataFrame:
    """One FeatureCollection document per group, for groups that are known to
    be small (a part of ``document_parts`` otherwise)."""
    return features.groupBy(group).agg(F.concat(
        F.lit('{"type":"FeatureCollection","features":['),
        F.array_join(F.array_sort(F.collect_list("feature")), ","), F.lit("]}")).alias("document"))


def group_documents(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """One JSON array document per group (e.g. the regions of one
    country, ordered), for groups that are known to be small."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order],
                                                 F.struct(*[F.col(c) for c in df.columns]).alias("__row"))))
    return df.groupBy(group).agg(F.to_json(F.transform(rows, lambda r: r["__row"])).alias("document"))


def flatten_documents(docs: DataFrame, schema) -> DataFrame:
    """A10: per-group arrays back to one row per element (the elements carry
    the group column themselves)."""
    arr = F.from_json("document", T.ArrayType(schema))
    return docs.select(F.explode(arr).alias("r")).select("r.*")


# S21 -------------------------------------------------------------------------------------
def typed_empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# S13 / S14 ---------------------------------------------------------------------------------
GDELT_DOC = T.StructType([T.StructField("articles", T.ArrayType(T.StructType([
    T.StructField("url", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("seendate", T.StringType()), T.StructField("domain", T.StringType()),
    T.StructField("language", T.StringType()), T.StructField("sourcecountry", T.StringType()),
])))])

RSS_ENTRY = T.StructType([
    T.StructField("link", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("published", T.StringType()), T.StructField("updated", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("outlet", T.StringType()),
])


def gdelt_articles(docs: DataFrame, country, iso_dates: bool = False) -> DataFrame:
    """Landed article-list payloads -> article records.  The outlet is the
    domain, else the source country; the language is lower-cased, an empty one
    is NULL; the date is passed through as the feed writes it, or with
    ``iso_dates`` turned from 'YYYYMMDDTHHMMSSZ' into ISO-8601 UTC."""
    a = docs.select(F.explode("articles").alias("a"), _c(country).alias("country"))
    seen = F.col("a.seendate")
    if iso_dates:
        at = F.try_to_timestamp(seen, F.lit("yyyyMMdd'T'HHmmss'Z'")).cast("timestamp_ntz")
        seen = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return a.select(F.col("a.url").alias("url"),
                    F.coalesce(F.nullif(F.col("a.domain"), F.lit("")), F.col("a.sourcecountry")).alias("outlet"),
                    seen.alias("published_at"),
                    F.nullif(F.lower(F.col("a.language")), F.lit("")).alias("language"),
                    F.coalesce(F.col("a.title"), F.lit("")).alias("title"), F.lit("").alias("lead"),
                    F.lit("gdelt").alias("source"), "country")


def rss_articles(entries: DataFrame, language: str | None = "en", lead_cap: int | None = None) -> DataFrame:
    """Feed entries -> article records; entries without a link are
    skipped; lead = first non-empty of summary/description with tags
    stripped and capped; the date is that of publication, else of the update,
    as ISO-8601 UTC (NULL if neither is a date)."""
    from harmoniq.functions.codes import feed_instant
    e = entries.filter(F.coalesce(F.col("link"), F.lit("")) != "")
    return e.select(F.col("link").alias("url"), F.col("outlet"),
                    F.coalesce(feed_instant("published"), feed_instant("updated")).alias("published_at"),
                    F.lit((language or "").lower() or None).cast("string").alias("language"),
                    F.coalesce(F.col("title"), F.lit("")).alias("title"),
                    F.coalesce(strip_html(first_non_empty("summary", "description"), lead_cap), F.lit(""))
                    .alias("lead"),
                    F.lit("rss").alias("source"), F.col("country"))
