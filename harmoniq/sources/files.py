"""Readers for landed files, all returning lazy DataFrames.

Every reader takes a path or glob (a folder of many files reads as one
scan, split by ``spark.sql.files.maxPartitionBytes``) and an explicit
schema where the format allows it, so no inference pass runs over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.text import decimal_comma


def all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# fixed values: the eight code points where ISO-8859-15 differs from ISO-8859-1
LATIN1_CHARS = "\u00a4\u00a6\u00a8\u00b4\u00b8\u00bc\u00bd\u00be"
LATIN9_CHARS = "\u20ac\u0160\u0161\u017d\u017e\u0152\u0153\u0178"


def single_byte_text(content, charset: str = "ISO-8859-15"):
    """Bytes of a single-byte charset -> text (ISO-8859-15 = Latin-1 plus
    eight replaced code points, applied with ``translate``)."""
    single = F.decode(F.col(content) if isinstance(content, str) else content, "ISO-8859-1")
    if charset.upper() in ("ISO-8859-15", "LATIN-9", "LATIN9"):
        single = F.translate(single, LATIN1_CHARS, LATIN9_CHARS)
    return single


def decode_text(content, fallback: str = "ISO-8859-15"):
    """Bytes -> text: UTF-8 when the bytes are valid UTF-8, else the
    fallback single-byte charset."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")).otherwise(single_byte_text(c, fallback))


# S1 --------------------------------------------------------------------------------
def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A missing input yields a typed empty frame instead of failing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001  (PATH_NOT_FOUND)
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


# S3 / S4 -----------------------------------------------------------------------------
def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ";",
                   header: bool = True, decimal_comma_cols: tuple[str, ...] = (),
                   encoding: str = "UTF-8", comment: str | None = None) -> DataFrame:
    """Delimited text with declared (string) columns; Spark strips a UTF-8
    BOM itself.  Columns listed in ``decimal_comma_cols`` turn '0,0135'
    into 0.0135 (NULL on junk)."""
    r = (spark.read.schema(all_strings(columns)).option("header", header).option("sep", sep)
         .option("encoding", encoding).option("mode", "PERMISSIVE"))
    if comment:
        r = r.option("comment", comment)
    df = r.csv(path)
    for c in decimal_comma_cols:
        df = df.withColumn(c, decimal_comma(c))
    return df


def read_sdmx_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """SDMX-CSV as all-string columns; the caller slices and casts."""
    return read_delimited(spark, path, columns, sep=",")


# S5 / S17 -----------------------------------------------------------------------------
def read_row_array(spark: SparkSession, path: str, row_schema: T.StructType,
                   field: str = "value", multiline: bool = False) -> DataFrame:
    """JSON documents holding a row array under ``field``; many slice
    files (S17) read as one glob, rows exploded with ``inline``."""
    doc = T.StructType([T.StructField(field, T.ArrayType(row_schema), True)])
    d = spark.read.schema(doc).option("multiLine", multiline).json(path)
    return d.select(F.inline(F.col(field)))


# S9 -------------------------------------------------------------------------------------
def read_mapping(spark: SparkSession, path: str,
                 columns=("native_code", "native_name", "nuts_code", "notes")) -> DataFrame:
    """Mapping dimension CSV; '#' lines are comments."""
    return read_delimited(spark, path, list(columns), sep=",", header=True, comment="#")


# S10 --------------------------------------------------------------------------------------
GEOJSON_FEATURES = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StringType()),   # raw JSON text, any geometry type
    ]))),
])


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection documents -> one row per feature with the
    properties map and the geometry kept as JSON text."""
    d = spark.read.schema(GEOJSON_FEATURES).option("multiLine", True).json(path)
    f = d.select(F.explode("features").alias("f"))
    return f.select(F.col("f.properties").alias("properties"), F.col("f.geometry").alias("geometry"))


# S11 --------------------------------------------------------------------------------------
def read_jsonl_variant(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines as VARIANT, blank lines skipped.  Files stay
    splittable; each line gets an ordinal (file, split start, row id) that
    follows file order: ``monotonically_increasing_id`` grows within a task
    and a task reads one contiguous split of one file."""
    t = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    # a blank line is no JSON text, in whatever order Spark evaluates filter and parser
    parsed = F.parse_json(F.when(F.trim("line") != "", F.col("line")))
    return t.filter(F.trim("line") != "").select("file", "block", "line_no", parsed.alias("v"))


def variant_field(v, path: str, typ: str = "string"):
    """(value, present): value cast to ``typ``; present is False when the
    key is absent and True when it is there, JSON null included."""
    raw = F.try_variant_get(v, path, "variant")
    return F.try_variant_get(v, path, typ), raw.isNotNull()


# S15 ---------------------------------------------------------------------------------------
def read_raw_archive(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Landed raw files with their SHA-256 (binaryFile source)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    b = r.load(path)
    return b.select("path", "length", F.sha2("content", 256).alias("sha256"))


def new_content(archive: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content hash is not in the manifest (unchanged = no-op)."""
    return archive.join(manifest.select("sha256").distinct(), "sha256", "left_anti")


# S16 ----------------------------------------------------------------------------------------
def read_evolving_csv(spark: SparkSession, parts: list[tuple[str, list[str]]]) -> DataFrame:
    """CSV parts written under different column sets (old files lack
    newer columns) unioned by name; missing columns are NULL."""
    frames = [read_delimited(spark, p, cols, sep=",") for p, cols in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# S23 ------------------------------------------------------------------------------------------
def discover(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Recursive discovery of files matching ``glob`` under ``root``;
    first hit (smallest path) per file name."""
    b = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
         .option("pathGlobFilter", glob).load(root).select("path"))
    named = b.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    return named.groupBy("name").agg(F.min("path").alias("path"))
