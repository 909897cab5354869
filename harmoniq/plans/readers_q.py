"""Reader bindings as round trips: each query derives an odd-shaped input
from a driver table with a Spark write into the shared checkpoint folder,
reads it back with the operator, and is checked against the plain table
query.  The derived files grow with the tables (no row caps)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.codes import label_by_rules, period_code_year, rolling_12m
from harmoniq.functions.metrics import bbox_centre
from harmoniq.functions.text import first_non_empty
from harmoniq.operators.harmonise import keep_latest, literal_table
from harmoniq.plans import register
from harmoniq.plans.common import nation_code, table
from harmoniq.session import scratch_path
from harmoniq.sources import files as S
from harmoniq.sources import shapes as H

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


# ---- S3 S2 S1 P5: ';' CSV with BOM and decimal comma -------------------------------------------
@register("delimited_roundtrip", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""")
def delimited_roundtrip(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("﻿o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
        F.regexp_replace(F.col("o_totalprice").cast("string"), r"\.", ",").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    csv_dir = scratch_path(spark, "orders_csv")
    text.write.option("sep", ";").option("header", True).csv(csv_dir)
    parsed = S.read_delimited(spark, csv_dir, ORDER_COLS, sep=";", decimal_comma_cols=("o_totalprice",))
    typed = parsed.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").try_cast("bigint").alias("o_custkey"), "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority").dropna(subset=["o_orderkey"])
    pq = scratch_path(spark, "orders_pq")
    typed.write.option("compression", "zstd").parquet(pq)
    return S.read_parquet(spark, pq)


# ---- S4 P2 P26 U2: SDMX-style cube CSV, equality slice ------------------------------------------
SDMX_COLS = ["REF_FLAG", "LINESTATUS", "DATA_TYPE", "TIME_PERIOD", "OBS_VALUE"]


@register("sdmx_slice", oracle="""
SELECT l_linestatus AS linestatus, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count
FROM lineitem GROUP BY 1, 2""")
def sdmx_slice(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("y"),
        F.col("l_quantity").cast("bigint").alias("q"))
    by_flag = li.groupBy("l_returnflag", "l_linestatus", "y").agg(
        F.sum("q").alias("qty"), F.count(F.lit(1)).alias("lines"))
    totals = li.groupBy("l_linestatus", "y").agg(
        F.sum("q").alias("qty"), F.count(F.lit(1)).alias("lines")).withColumn("l_returnflag", F.lit("TOTAL"))
    cube = by_flag.unionByName(totals)
    root = scratch_path(spark, "sdmx")
    for dtype, col in (("QTY", "qty"), ("LINES", "lines")):   # one file set per data type (U2)
        cube.select(F.col("l_returnflag").alias("REF_FLAG"), F.col("l_linestatus").alias("LINESTATUS"),
                    F.lit(dtype).alias("DATA_TYPE"), F.col("y").cast("string").alias("TIME_PERIOD"),
                    F.col(col).cast("string").alias("OBS_VALUE")) \
            .write.option("header", True).csv(f"{root}/{dtype.lower()}")
    raw = S.read_sdmx_csv(spark, f"{root}/*", SDMX_COLS)
    sl = raw.filter((F.col("REF_FLAG") == "TOTAL") & (F.col("DATA_TYPE") == "QTY")
                    & F.col("LINESTATUS").isin("F", "O"))
    return sl.select(F.col("LINESTATUS").alias("linestatus"),
                     F.col("TIME_PERIOD").try_cast("int").alias("year"),
                     F.col("OBS_VALUE").try_cast("bigint").alias("count"))


# ---- S5 S17 F8: row arrays in JSON documents, one per 2-year slice ----------------------------
ROW_SCHEMA = T.StructType([T.StructField("Perioden", T.StringType()),
                           T.StructField("SoortMisdrijf", T.StringType()),
                           T.StructField("count", T.LongType())])


@register("row_array", oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, COUNT(*) AS count
FROM orders GROUP BY 1, 2""")
def row_array(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    agg = o.groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    docs = (agg.withColumn("slice", F.floor(F.col("y") / 2))
            .groupBy("slice").agg(F.collect_list(F.struct(
                F.concat(F.col("y").cast("string"), F.lit("JJ00")).alias("Perioden"),
                F.lpad("o_orderpriority", 20, " ").alias("SoortMisdrijf"),
                F.col("n").alias("count"))).alias("value")))
    path = scratch_path(spark, "row_array")
    docs.write.partitionBy("slice").json(path)
    rows = S.read_row_array(spark, f"{path}/*", ROW_SCHEMA)
    return rows.select(period_code_year("Perioden").alias("year"),
                       F.trim("SoortMisdrijf").alias("o_orderpriority"), "count")


# ---- S6: JSON-stat cube fold / unfold -------------------------------------------------------
CUBE_SCHEMA = T.StructType([
    T.StructField("year_index", T.ArrayType(T.StringType())),
    T.StructField("year_label", T.MapType(T.StringType(), T.StringType())),
    T.StructField("prio_index", T.ArrayType(T.StringType())),
    T.StructField("prio_label", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.ArrayType(T.LongType())),
])


@register("cube_unfold", oracle="""
WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS prio, COUNT(*) AS value
           FROM orders GROUP BY 1, 2)
SELECT year, prio, 'Year ' || CAST(year AS VARCHAR) AS year_name, lower(prio) AS prio_name, value FROM c""")
def cube_unfold(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cells = o.groupBy(F.year("o_orderdate").cast("string").alias("y"), F.col("o_orderpriority").alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    dims = cells.agg(F.array_sort(F.collect_set("y")).alias("year_index"),
                     F.array_sort(F.collect_set("p")).alias("prio_index"))
    grid = (dims.select("year_index", "prio_index", F.posexplode("year_index").alias("yi", "y"))
            .select("*", F.posexplode("prio_index").alias("pi", "p"))
            .withColumn("pos", F.col("yi") * F.size("prio_index") + F.col("pi")))
    dense = grid.join(cells, ["y", "p"], "left")
    doc = dense.groupBy("year_index", "prio_index").agg(
        F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("cells"))
    doc = doc.select(
        "year_index", F.map_from_arrays("year_index", F.transform("year_index", lambda y: F.concat(F.lit("Year "), y)))
        .alias("year_label"),
        "prio_index", F.map_from_arrays("prio_index", F.transform("prio_index", lambda p: F.lower(p)))
        .alias("prio_label"),
        F.transform("cells", lambda c: c["n"]).alias("value"))
    path = scratch_path(spark, "cube")
    doc.write.json(path)
    cube = spark.read.schema(CUBE_SCHEMA).json(path)
    out = H.unfold_cube(cube, ["year", "prio"])
    return out.withColumn("year", F.col("year").cast("int"))


# ---- S7 W2 P7 P9: sectioned text, one file per region ------------------------------------------
@register("section_scan", oracle="""
SELECT n.n_name AS section, l.l_returnflag AS label, CAST(year(l.l_shipdate) AS INTEGER) AS year,
       CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS count
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY 1, 2, 3""")
def section_scan(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    agg = (li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
           .groupBy("n_regionkey", "n_name", "l_returnflag", F.year("l_shipdate").alias("y"))
           .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q")))
    years = agg.select(F.array_sort(F.collect_set("y"))).scalar()
    fmt = F.regexp_replace(F.format_number("q", 0), ",", ".")
    keys = agg.select("n_regionkey", "n_name", "l_returnflag").distinct()
    grid = keys.select("*", F.explode(years).alias("y"))
    cells = grid.join(agg.select("n_regionkey", "n_name", "l_returnflag", "y", fmt.alias("v")),
                      ["n_regionkey", "n_name", "l_returnflag", "y"], "left")
    rows = cells.groupBy("n_regionkey", "n_name", "l_returnflag").agg(
        F.array_sort(F.collect_list(F.struct("y", F.coalesce("v", F.lit("-")).alias("v")))).alias("cells"))
    data = rows.select("n_regionkey", F.lit(2).alias("o1"), "n_name", F.lit(1).alias("o2"), "l_returnflag",
                       F.concat(F.lit("    "), F.col("l_returnflag"), F.lit("\t"),
                                F.array_join(F.transform("cells", lambda c: c["v"]), "\t")).alias("line"))
    nations = rows.select("n_regionkey", "n_name").distinct()
    heads = nations.select("n_regionkey", F.lit(2).alias("o1"), "n_name", F.lit(0).alias("o2"),
                           F.lit("").alias("l_returnflag"),
                           F.concat(F.col("n_name"), F.lit("\t")).alias("line"))
    regions = nations.select("n_regionkey").distinct()
    title = regions.select("n_regionkey", F.lit(0).alias("o1"), F.lit("").alias("n_name"), F.lit(0).alias("o2"),
                           F.lit("").alias("l_returnflag"), F.lit("Quantities by nation and flag").alias("line"))
    yline = regions.select("n_regionkey", F.lit(1).alias("o1"), F.lit("").alias("n_name"), F.lit(0).alias("o2"),
                           F.lit("").alias("l_returnflag"),
                           F.concat(F.lit("\t"), F.array_join(years.cast("array<string>"), "\t"))
                           .alias("line"))
    lines = title.unionByName(yline).unionByName(heads).unionByName(data)
    path = scratch_path(spark, "sections")
    (lines.repartition("n_regionkey")
     .sortWithinPartitions("n_regionkey", "o1", "n_name", "o2", "l_returnflag")
     .select("n_regionkey", "line").write.partitionBy("n_regionkey").text(path))
    parsed = H.section_counts(H.read_sections(spark, f"{path}/*"))
    return parsed.select("section", "label", "year", "count")


# ---- S8 P8 P10 F6 F7: spreadsheet cell table ---------------------------------------------------
# fixed values: header texts of the measure columns (with a note tag and odd spacing)
SHEET_HEADERS = [("A", "Returned\n [note 1]"), ("N", " Not  returned"), ("R", "Refused [note 2]")]
SHEET_BOILERPLATE = ["Table 1: Quantities by area", "Source: line items", "",
                     "Notes are at the end", "Figures are sums of quantities", ""]


@register("sheet_scan", oracle="""
SELECT 'R' || CAST(n.n_regionkey AS VARCHAR) || chr(65 + n.n_nationkey) AS key_1, n.n_name AS key_2,
       CASE l.l_returnflag WHEN 'A' THEN 'Returned' WHEN 'N' THEN 'Not returned' ELSE 'Refused' END AS measure,
       CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS count
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY 1, 2, 3""")
def sheet_scan(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    agg = (li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
           .groupBy("n_regionkey", "n_nationkey", "n_name", "l_returnflag")
           .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q")))
    flag_col = F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "N", 3).otherwise(4)
    row = (F.col("n_nationkey") + 8).cast("int")
    data_cells = agg.select(row.alias("row"), flag_col.cast("int").alias("col"), F.col("q").cast("string").alias("value"))
    nat = n.select(row.alias("row"), F.lit(0).alias("col"),
                   nation_code("n_regionkey", "n_nationkey").alias("value")).unionByName(
        n.select(row.alias("row"), F.lit(1).alias("col"), F.col("n_name").alias("value")))
    fixed = [(i + 1, 0, t) for i, t in enumerate(SHEET_BOILERPLATE)] + [(7, 0, "Area  Code"), (7, 1, "Area Name")] + \
        [(7, i + 2, h) for i, (_, h) in enumerate(SHEET_HEADERS)]
    fixed_df = literal_table(spark, fixed, T.StructType([
        T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()),
        T.StructField("value", T.StringType())]))
    cells = (data_cells.unionByName(nat).unionByName(fixed_df)
             .select(F.lit("quantities.xlsx").alias("file"), F.lit("Table 1").alias("sheet"), "row", "col", "value"))
    path = scratch_path(spark, "cells")
    cells.write.parquet(path)
    rec = H.sheet_records(spark.read.schema(H.CELL_TABLE).parquet(path), "Table", "Area Code", 2)
    return rec.select("key_1", "key_2", "measure", F.col("value").try_cast("bigint").alias("count")) \
        .filter(F.col("count").isNotNull())


# ---- S9 F23 P1 P17: mapping CSV with comments, label from file name ---------------------------
MAP_TAGS_SQL = "CASE WHEN n_regionkey IN (0, 1) THEN 'deutsch' WHEN n_regionkey IN (2, 3) THEN 'nichtdeutsch' ELSE 'gesamt' END"
# fixed value: country-code override (code -> replacement), like UK -> gb
COUNTRY_OVERRIDE = {"R0": "af"}


@register("mapping_scan", oracle=f"""
SELECT CAST(n_nationkey AS VARCHAR) AS native_code,
       'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) AS nuts_code,
       CASE WHEN n_regionkey IN (2, 3) THEN 'foreign' WHEN n_regionkey IN (0, 1) THEN 'national' ELSE 'total' END AS dim,
       CASE WHEN n_regionkey = 0 THEN 'af' ELSE lower('R' || CAST(n_regionkey AS VARCHAR)) END AS country
FROM nation WHERE n_nationkey NOT IN (5, 6)""")
def mapping_scan(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    tag = F.expr(MAP_TAGS_SQL)
    notes = F.when(F.col("n_nationkey").isin(5, 6), "skip").otherwise("ok")
    data = n.select(tag.alias("tag"), F.lit(2).alias("o"), F.concat_ws(
        ",", F.col("n_nationkey").cast("string"), F.col("n_name"),
        nation_code("n_regionkey", "n_nationkey"), notes).alias("line"))
    tags = data.select("tag").distinct()
    header = tags.select("tag", F.lit(0).alias("o"), F.lit("native_code,native_name,nuts_code,notes").alias("line"))
    comment = tags.select("tag", F.lit(1).alias("o"), F.lit("# generated from the nation table").alias("line"))
    path = scratch_path(spark, "region_maps")
    (header.unionByName(comment).unionByName(data).repartition("tag")
     .sortWithinPartitions("tag", "o", "line").select("tag", "line").write.partitionBy("tag").text(path))
    m = S.read_mapping(spark, f"{path}/*").withColumn("__f", F.col("_metadata.file_path"))
    m = m.filter(F.col("notes").isin("ok"))                                        # P1
    dim = label_by_rules("__f", [("nichtdeutsch", "foreign"), ("deutsch", "national")], "total")  # P17
    cc = F.left("nuts_code", F.lit(2))
    override = F.create_map(*[x for k, v in COUNTRY_OVERRIDE.items() for x in (F.lit(k), F.lit(v))])
    return m.select("native_code", "nuts_code", dim.alias("dim"),
                    F.coalesce(F.element_at(override, cc), F.lower(cc)).alias("country"))


# ---- S10 F20 P24 P27: GeoJSON regions -> centroids -------------------------------------------
# fixed values: (country, level) pairs kept for the map
KEEP_PAIRS = [("R0", 1), ("R1", 1), ("R2", 1), ("R3", 1)]


def write_region_geojson(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    x0 = F.col("n_nationkey") * 2.0
    y0 = F.col("n_regionkey") * 3.0

    def ring(dx):
        pts = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
        return F.concat(F.lit("[["), F.concat_ws("],[", *[
            F.concat(F.format_string("%.1f", x0 + dx + a), F.lit(","), F.format_string("%.1f", y0 + dx + b))
            for a, b in pts]), F.lit("]]"))
    multi = F.col("n_regionkey").isin(1, 3)
    geom = F.when(multi, F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring(0), F.lit("],["),
                                  ring(10), F.lit("]]}"))) \
        .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(0), F.lit("]}")))
    props = F.to_json(F.struct(
        nation_code("n_regionkey", "n_nationkey").alias("NUTS_ID"),
        F.when(F.col("n_nationkey") >= 20, F.lit("")).otherwise(F.col("n_name")).alias("NAME_LATN"),
        F.lower("n_name").alias("NUTS_NAME"), F.lit("1").alias("LEVL_CODE"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("CNTR_CODE")))
    feat = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geom, F.lit("}"))
    docs = n.groupBy("n_regionkey").agg(F.concat(
        F.lit('{"type":"FeatureCollection","features":['),
        F.array_join(F.collect_list(feat), ","), F.lit("]}")).alias("value"))
    path = scratch_path(spark, "geojson")
    docs.write.partitionBy("n_regionkey").text(path)
    return path


@register("geojson_centroid", oracle="""
SELECT 'R' || CAST(n_regionkey AS VARCHAR) || chr(65 + n_nationkey) AS code,
       CASE WHEN n_nationkey >= 20 THEN lower(n_name) ELSE n_name END AS name,
       1 AS level, 'R' || CAST(n_regionkey AS VARCHAR) AS country,
       CAST(n_nationkey * 2.0 + CASE WHEN n_regionkey IN (1, 3) THEN 5.5 ELSE 0.5 END AS DOUBLE) AS centroid_lon,
       CAST(n_regionkey * 3.0 + CASE WHEN n_regionkey IN (1, 3) THEN 5.5 ELSE 0.5 END AS DOUBLE) AS centroid_lat
FROM nation WHERE n_regionkey IN (0, 1, 2, 3)""")
def geojson_centroid(spark, sf_dir):
    path = write_region_geojson(spark, sf_dir)
    f = S.read_geojson(spark, f"{path}/*")
    p = F.col("properties")
    code = p["NUTS_ID"]
    cx, cy = bbox_centre("geometry")
    out = f.select(code.alias("code"), first_non_empty(p["NAME_LATN"], p["NUTS_NAME"], code).alias("name"),
                   p["LEVL_CODE"].try_cast("int").alias("level"),
                   F.coalesce(F.nullif(p["CNTR_CODE"], F.lit("")), F.left(code, F.lit(2))).alias("country"),
                   cx.alias("centroid_lon"), cy.alias("centroid_lat"))
    keep = literal_table(spark, KEEP_PAIRS, T.StructType([T.StructField("country", T.StringType()),
                                                          T.StructField("level", T.IntegerType())]))
    return out.join(F.broadcast(keep), ["country", "level"], "left_semi")          # P24


# ---- S22 P16: newest landed release among the last six quarter ends -------------------------------
AS_OF = "2001-08-01"


@register("release_pick", oracle="""
SELECT o_orderkey, o_orderdate, DATE '2000-07-01' AS period_start, DATE '2001-06-30' AS period_end
FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-04-01' AND o_orderdate < TIMESTAMP '2001-07-01'""")
def release_pick(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    qend = F.last_day(F.add_months(F.trunc(F.to_date("o_orderdate"), "quarter"), 2))
    name = F.concat(F.lit("year_ending_"), F.date_format(qend, "MMMM"), F.lit("_"), F.year(qend).cast("string"))
    path = scratch_path(spark, "releases")
    o.withColumn("release", name).write.partitionBy("release").parquet(path)
    landed = spark.read.parquet(path).withColumn("name", F.col("_metadata.file_path"))
    picked = H.pick_release(landed, AS_OF, 6)
    start, end = rolling_12m(F.month("release_end"), F.year("release_end"))              # P15: the release covers 12 months to its month
    return picked.select("o_orderkey", "o_orderdate", start.alias("period_start"), end.alias("period_end"))


# ---- P9 P10 P8 P12: a sheet whose years are columns ------------------------------------------------
@register("year_columns_scan", oracle="""
WITH c AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS value
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, year, value FROM c WHERE year = (SELECT max(year) FROM c)""")
def year_columns_scan(spark, sf_dir):
    """Counts per priority with one column per year (headers padded with
    stray spaces, as spreadsheets deliver them) -> cleaned names -> year
    columns found by shape -> unpivot -> latest year only."""
    o = table(spark, sf_dir, "orders")
    wide = (o.withColumn("y", F.concat(F.lit(" "), F.year("o_orderdate").cast("string"), F.lit("  ")))
            .groupBy("o_orderpriority").pivot("y").agg(F.count(F.lit(1))))
    path = scratch_path(spark, "year_columns")
    wide.write.parquet(path)
    tidy = H.clean_columns(spark.read.parquet(path))
    long = H.unpivot_years(tidy, ["o_orderpriority"]).filter(F.col("value").isNotNull())
    return keep_latest(long, "year")
