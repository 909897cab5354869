"""Odd-shaped statistical inputs: JSON-stat cubes (S6), sectioned text
(S7), spreadsheet cell tables (S8), release-file candidates (S22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.codes import release_from_name
from harmoniq.functions.text import clean_header, collapse_ws, digits_only_long
from harmoniq.session import materialize


# S6 ------------------------------------------------------------------------------------
def unfold_cube(cube: DataFrame, dims: list[str], value: str = "value",
                index_suffix: str = "_index", label_suffix: str = "_label") -> DataFrame:
    """JSON-stat unfold: a flat row-major ``value`` array plus, per
    dimension d, ``d_index`` (category ids in order) and ``d_label`` (map id
    -> label) -> one long row per non-null cell.  Cell position is decoded
    with mixed radix (last dimension fastest)."""
    sizes = [F.size(F.col(f"{d}{index_suffix}")) for d in dims]
    cells = cube.select("*", F.posexplode(F.col(value)).alias("__pos", "__val")).filter(
        F.col("__val").isNotNull())
    out = [F.col("__val").alias(value)]
    stride: Column = F.lit(1)
    for d, size in reversed(list(zip(dims, sizes, strict=True))):
        idx = (F.floor(F.col("__pos") / stride) % size).cast("int")
        cat = F.element_at(F.col(f"{d}{index_suffix}"), idx + 1)
        out.append(cat.alias(d))
        out.append(F.element_at(F.col(f"{d}{label_suffix}"), cat).alias(f"{d}_name"))
        stride = stride * size
    return cells.select(*reversed(out))


# S7 -------------------------------------------------------------------------------------
def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, id, value) of every line: (split, id) ascends in file
    order, because a task reads a split from its start to its end.  ``value``
    holds the line's bytes as they are (no decoding)."""
    t = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("id"), "value")


def read_sections(spark: SparkSession, path: str,
                  fallback_encoding: str = "ISO-8859-15") -> DataFrame:
    """Sectioned text.  The year header is the first line
    with a 4-digit tab field (its 4-digit fields are the years; a file
    without one is an error); after it, a non-blank line without leading whitespace
    opens a section (its name is the line without trailing tabs), and an
    indented line 'label<TAB>v1<TAB>v2...' is a data row of that section;
    values beyond the year columns are ignored.  Returns (file, section,
    label, year, raw_value).  A file's bytes are decoded as UTF-8, or as
    ``fallback_encoding`` when any of its lines is not valid UTF-8.

    Files are read in splits, of which any task holds one: the open section is
    carried across by a small table of each split's last header line, filled
    over the splits of a file, and then filled down inside each split."""
    from harmoniq.sources.files import single_byte_text
    t = text_lines(spark, path)
    ascii_text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")   # year fields are plain digits
    fields = F.transform(F.split(F.regexp_replace(ascii_text, "\r$", ""), "\t"), lambda p: F.trim(p))
    year_fields = F.filter(fields, lambda p: p.rlike("^[0-9]{4}$"))
    years = (t.select("file", "split", "id", year_fields.alias("years")).filter(F.size("years") > 0)
             .groupBy("file").agg(F.min(F.struct("split", "id", "years")).alias("found")))
    encoding = t.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    missing = F.raise_error(F.concat(F.lit("no year header in "), F.col("file"))).cast("struct<split:bigint,id:bigint>")
    files = encoding.join(years, "file", "left").select("file", "utf8", "found.years", F.when(
        F.col("found").isNull(), missing).otherwise(F.struct("found.split", "found.id")).alias("after"))
    text = F.when(F.col("utf8"), F.col("value")).otherwise(
        single_byte_text(F.col("value").cast("binary"), fallback_encoding))
    line = F.col("line")
    indented = line.startswith(" ") | line.startswith("\t")
    opens = F.when((F.trim(line) != "") & ~indented, F.trim(F.regexp_replace(line, "\t+$", "")))
    body = (t.join(files, "file").filter(F.struct("split", "id") > F.col("after"))
            .select("file", "split", "id", "years", F.regexp_replace(text, "\r$", "").alias("line"))
            .withColumn("opens", opens).withColumn("indented", indented))

    last = body.filter("opens is not null").groupBy("file", "split").agg(F.max_by("opens", "id").alias("last"))
    splits = body.select("file", "split").distinct().join(last, ["file", "split"], "left")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("file", "split", F.last("last", ignorenulls=True).over(earlier).alias("carried"))

    down = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    tagged = (body.withColumn("own", F.last("opens", ignorenulls=True).over(down)).filter("indented")
              .join(carried, ["file", "split"], "left"))
    parts = F.split(line, "\t")
    rows = tagged.select(
        "file", F.coalesce("own", "carried", F.lit("")).alias("section"),
        F.trim(F.element_at(parts, 1)).alias("label"), F.slice(parts, 2, F.size(parts)).alias("vals"),
        "years").filter(F.col("label") != "")
    z = rows.select("file", "section", "label", F.explode(F.arrays_zip("years", "vals")).alias("z"))
    z = z.filter(F.col("z.years").isNotNull())
    return z.select("file", "section", "label", F.col("z.years").cast("int").alias("year"),
                    F.col("z.vals").alias("raw_value"))


def section_counts(sections: DataFrame) -> DataFrame:
    """P7 on a section scan: '1.234' -> 1234; '', '-', '.' are missing."""
    return (sections.withColumn("count", digits_only_long("raw_value"))
            .filter(F.col("count").isNotNull()).drop("raw_value"))


# S8 ---------------------------------------------------------------------------------------
CELL_TABLE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("sheet", T.StringType()),
    T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()),
    T.StructField("value", T.StringType()),
])


def sheet_records(cells: DataFrame, sheet_prefix: str, header_text: str,
                  key_cols: int = 2) -> DataFrame:
    """Cell table -> long records.  Picks sheets by name prefix, finds the
    header row as the first row whose column-0 text equals ``header_text``
    (whitespace-collapsed, case-folded), names columns by their cleaned
    header text (note tags dropped), and emits one row per (data row,
    measure column): (file, sheet, row, key_1..key_n, measure, value)."""
    c = cells.filter(F.col("sheet").startswith(sheet_prefix))
    hdr_row = (c.filter((F.col("col") == 0)
                        & (F.lower(collapse_ws("value")) == header_text.lower()))
               .groupBy("file", "sheet").agg(F.min("row").alias("__hr")))
    c = c.join(hdr_row, ["file", "sheet"])
    headers = (c.filter(F.col("row") == F.col("__hr"))
               .select("file", "sheet", "col", clean_header("value").alias("header")))
    data = c.filter(F.col("row") > F.col("__hr")).drop("__hr")
    keys = (data.filter(F.col("col") < key_cols).groupBy("file", "sheet", "row")
            .agg(*[F.max(F.when(F.col("col") == k, F.col("value"))).alias(f"key_{k + 1}")
                   for k in range(key_cols)]))
    measures = (data.filter(F.col("col") >= key_cols)
                .join(headers, ["file", "sheet", "col"])
                .select("file", "sheet", "row", F.col("header").alias("measure"), "value"))
    return keys.join(measures, ["file", "sheet", "row"])


# S22 ----------------------------------------------------------------------------------------
def release_candidates(as_of, n: int = 6) -> Column:
    """The last ``n`` quarter ends on or before ``as_of``, newest first."""
    d = as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))
    q_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    latest = F.when(q_end <= d, q_end).otherwise(F.last_day(F.add_months(q_end, -3)))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.last_day(F.add_months(latest, -3 * i)))


def pick_release(landed: DataFrame, as_of, n: int = 6, name_col: str = "name") -> DataFrame:
    """Landed files whose name encodes the newest candidate release.  Releases
    that have landed but are none of the ``n`` candidates are an error that
    lists their dates; nothing landed gives no rows.  Names are read once per
    file, not per row: the rows of the picked files are found by their name."""
    month, year = release_from_name(F.col("__name"))
    files = landed.select(F.col(name_col).alias("__name")).distinct()
    # stored: else Spark moves the parsing below the distinct and the join, to the rows
    files = materialize(files.select("__name", F.last_day(F.make_date(year, month, F.lit(1))).alias("release_end")))
    known = files.filter("release_end is not null")
    hit = F.array_contains(release_candidates(as_of, n), F.col("release_end"))
    newest = known.select(F.max(F.when(hit, F.col("release_end")))).scalar()
    landed_ends = known.select(F.array_join(F.transform(F.array_sort(F.collect_set("release_end")),
                                                        lambda d: d.cast("string")), ", ")).scalar()
    wanted = F.coalesce(newest, F.raise_error(F.concat(F.lit(f"none of the last {n} releases has landed, only: "), landed_ends)).cast("date"))
    picked = known.filter(F.col("release_end") == wanted)          # a row per file name
    return landed.join(F.broadcast(picked), F.col(name_col) == F.col("__name")).drop("__name")


# P9 / P10 ------------------------------------------------------------------------------------
def clean_columns(df: DataFrame) -> DataFrame:
    """P10: column names with whitespace runs collapsed and trimmed (a
    metadata-only rename)."""
    import re
    return df.toDF(*[re.sub(r"\s+", " ", c).strip() for c in df.columns])


def year_columns(df: DataFrame) -> list[str]:
    """The columns whose (cleaned) name is a 4-digit year, in order."""
    import re
    return [c for c in df.columns if re.fullmatch(r"[0-9]{4}", c)]


def unpivot_years(df: DataFrame, ids: list[str], value: str = "value") -> DataFrame:
    """Wide year columns -> (ids..., year, value) rows (P8 on P9's columns)."""
    years = year_columns(df)
    long = df.unpivot(ids, years, "year", value)
    return long.withColumn("year", F.col("year").cast("int"))
