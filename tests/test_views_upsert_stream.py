"""Upsert properties, as-of lookups against a naive loop, derived totals,
readers on fixture files, streaming = batch."""

from __future__ import annotations

import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harmoniq.operators import views as V
from harmoniq.operators.upsert import read_version, upsert, write_version
from harmoniq.session import to_local_path
from harmoniq.sources import files as S
from harmoniq.sources.shapes import unfold_cube
from harmoniq.streaming import intake as I

KEY = "k1 string, k2 string, v long"


def py_upsert(existing, new):
    norm = lambda r: (r[0] or "", r[1] or "")     # noqa: E731  NULL == ''
    keys = {norm(r) for r in new}
    return sorted([r for r in existing if norm(r) not in keys] + list(new), key=repr)


rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "", None]), st.sampled_from(["x", None, ""]),
                             st.integers(0, 5)), max_size=8)


@settings(max_examples=12, deadline=None)
@given(rows_st, rows_st)
def test_upsert_matches_model_and_is_idempotent(spark, existing, new):
    e = spark.createDataFrame(existing, KEY)
    n = spark.createDataFrame(new, KEY)
    once = upsert(e, n, ["k1", "k2"])
    got = sorted((tuple(r) for r in once.collect()), key=repr)
    assert got == py_upsert(existing, new)
    twice = sorted((tuple(r) for r in upsert(once, n, ["k1", "k2"]).collect()), key=repr)
    assert twice == got


def test_upsert_batch_collapse_and_versions(spark, scratch):
    e = spark.createDataFrame([("a", None, 1)], KEY)
    n = spark.createDataFrame([("a", "", 2, 1), ("a", None, 3, 2)], KEY + ", seq int")
    out = upsert(e, n, ["k1", "k2"], order="seq")
    assert [tuple(r) for r in out.collect()] == [("a", None, 3)]
    root = scratch("versions")
    write_version(e, root, 1)
    write_version(out, root, 2)
    assert [r["v"] for r in read_version(spark, root).collect()] == [3]
    assert [r["v"] for r in read_version(spark, root, 1).collect()] == [1]


def naive_asof(hist, code, yr, tol=4):
    for y in range(yr, yr - tol - 1, -1):
        v = hist.get((code, y))
        if v is not None:
            return v, y
    return None, None


def test_asof_and_fallback_against_loop(spark):
    rnd = random.Random(7)
    hist = {}
    for code in ("AB", "AB1", "AB2", "CD", "CD9"):
        for y in range(2000, 2012):
            if rnd.random() < 0.5:
                hist[(code, y)] = rnd.choice([None, round(rnd.random() * 10, 3)])
    hdf = spark.createDataFrame([(c, y, "m", v) for (c, y), v in hist.items()],
                                "code string, year int, metric string, rate double")
    targets = spark.createDataFrame([(c, y, "m") for c in ("AB1", "AB2", "CD9", "AB", "ZZ1") for y in range(1998, 2014)],
                                    "code string, year int, metric string")
    own = {(r["code"], r["year"]): (r["rate"], r["found_year"])
           for r in V.asof_lookup(targets, hdf, "code", "year", "metric", "rate").collect()}
    for (c, y), got in own.items():
        assert got == naive_asof(hist, c, y), (c, y)
    fb = {(r["code"], r["year"]): (r["rate"], r["source_level"])
          for r in V.asof_with_fallback(targets, hdf, "code", "year", "metric", "rate").collect()}
    for (c, y), (rate, level) in fb.items():
        v, _ = naive_asof(hist, c, y)
        if v is not None:
            assert (rate, level) == (v, "self")
        else:
            pv, _ = naive_asof(hist, c[:2], y) if c[:2] != c else (None, None)
            assert (rate, level) == (pv, "country" if pv is not None else None)


def test_derived_total_rules(spark):
    h = spark.createDataFrame([
        ("R1", 2020, "homicide", 5, 1.5), ("R1", 2020, "robbery_violent", None, 2.0),
        ("R2", 2020, "homicide", 1, None), ("R2", 2020, "violent_total", 9, 3.0),
        ("R3", 2020, "knife_offence", 4, 1.0)], "region_code string, yr int, crime_category string, count long, rate double")
    d = {(r["region_code"], r["crime_category"]): r for r in V.with_derived_total(h).collect() if r["derived"]}
    assert list(d) == [("R1", "violent_total")]
    assert (d[("R1", "violent_total")]["count"], d[("R1", "violent_total")]["rate"]) == (5, 3.5)


def test_sibling_rank_ties_by_code(spark):
    s = spark.createDataFrame([("X", 1, "X1", 2.0), ("X", 1, "X2", 2.0), ("X", 1, "X3", None), ("X", 1, "X0", 5.0)],
                              "source_country string, region_level int, region_code string, r double")
    got = [(r["region_code"], r["rank"], r["of_n"]) for r in V.sibling_rank(s, "r").orderBy("rank").collect()]
    assert got == [("X0", 1, 3), ("X1", 2, 3), ("X2", 3, 3)]


def test_cube_unfold_three_dims(spark):
    cube = spark.createDataFrame([(["a", "b"], {"a": "A", "b": "B"}, ["x", "y", "z"], {"x": "X", "y": "Y", "z": "Z"},
                                   ["1", "2"], {"1": "one", "2": "two"}, list(range(12)))],
                                 "d1_index array<string>, d1_label map<string,string>, d2_index array<string>, "
                                 "d2_label map<string,string>, d3_index array<string>, d3_label map<string,string>, "
                                 "value array<long>")
    cube = cube.withColumn("value", F.transform("value", lambda v: F.when(v != 5, v)))
    rows = {(r["d1"], r["d2"], r["d3"]): r["value"] for r in unfold_cube(cube, ["d1", "d2", "d3"]).collect()}
    assert len(rows) == 11 and rows[("b", "z", "2")] == 11 and rows[("a", "y", "1")] == 2
    assert ("a", "z", "2") not in rows                     # position 5 was a null cell


def test_discovery_raw_archive_and_empty(spark, scratch):
    root = to_local_path(scratch("landed"))
    for sub, body in (("a", "one"), ("b", "two"), ("b/c", "one")):
        os.makedirs(os.path.join(root, sub), exist_ok=True)
        with open(os.path.join(root, sub, "data.csv"), "w") as f:
            f.write(body)
    found = S.discover(spark, root, "data.csv").collect()
    assert len(found) == 1 and found[0]["path"].endswith("/a/data.csv")
    arch = S.read_raw_archive(spark, root, "*.csv")
    manifest = arch.filter(F.col("path").endswith("/a/data.csv")).select("sha256")
    assert [r["path"].split(root)[-1] for r in S.new_content(arch, manifest).collect()] == ["/b/data.csv"]
    from harmoniq.schema import NUTS_REGIONS
    empty = S.read_or_empty(spark, os.path.join(root, "missing"), NUTS_REGIONS)
    assert empty.count() == 0 and empty.schema == NUTS_REGIONS


def test_stream_equals_batch(spark, scratch):
    land = scratch("land")
    rows = [(i % 7, f"2024-01-{1 + i % 28:02d} 00:00:00", i) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, ts string, v long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.repartition(4).write.parquet(land)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(land)
    sink, ckpt = scratch("sink"), scratch("ckpt")
    I.run_available(I.dedupe_stream(stream, ["k"], "ts", "40 days"), sink, ckpt)
    assert sorted(r["k"] for r in spark.read.parquet(sink).collect()) == list(range(7))
    root, ck2 = scratch("tbl"), scratch("ck2")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(land)
    I.upsert_batches(spark, stream, root, ck2, ["k"], ["ts", "v"])
    allv = spark.read.parquet(root)
    latest = allv.filter(F.col("version") == allv.select(F.max("version")).scalar()).drop("version")
    batch = df.groupBy("k").agg(F.max_by("v", F.struct("ts", "v")).alias("v"))
    assert sorted((r["k"], r["v"]) for r in latest.collect()) == sorted((r["k"], r["v"]) for r in batch.collect())


def test_upsert_partitions_rewrites_touched_only(spark, scratch):
    from harmoniq.operators.upsert import upsert_partitions
    path = scratch("facts")
    base = spark.createDataFrame([("FR", "a", 1), ("FR", "b", 2), ("DE", "a", 3)], "country string, k string, v long")
    base.write.partitionBy("country").parquet(path)
    import glob
    de_files = sorted(glob.glob(to_local_path(path) + "/country=DE/*.parquet"))
    inc = spark.createDataFrame([("FR", "a", 10), ("FR", "c", 30)], "country string, k string, v long")
    out = upsert_partitions(spark, path, inc, ["country", "k"], ["country"])
    assert sorted((r["country"], r["k"], r["v"]) for r in out.collect()) == \
        [("DE", "a", 3), ("FR", "a", 10), ("FR", "b", 2), ("FR", "c", 30)]
    assert sorted(glob.glob(to_local_path(path) + "/country=DE/*.parquet")) == de_files


def test_sections_with_latin9_fallback(spark, scratch):
    from harmoniq.sources.shapes import read_sections, section_counts
    root = to_local_path(scratch("sections"))
    os.makedirs(root, exist_ok=True)
    body = ("Infracciones penales\nBalance 2024\n\n\t2023\t2024\nÁlava\t\n    Homicidios\t1.234\t-\t99\n"
            "    Robos con violencia\t.\t56\n\tTotal\t\t\nCastellón €\t\n    Homicidios\t7\t8\n")
    with open(os.path.join(root, "utf8.txt"), "w", encoding="utf-8") as f:
        f.write(body)
    with open(os.path.join(root, "latin9.txt"), "w", encoding="iso-8859-15") as f:
        f.write(body)
    got = sorted((r["file"].rsplit("/", 1)[-1], r["section"], r["label"], r["year"], r["count"])
                 for r in section_counts(read_sections(spark, root)).collect())
    expect = [("Castellón €", "Homicidios", 2023, 7), ("Castellón €", "Homicidios", 2024, 8),
              ("Álava", "Homicidios", 2023, 1234), ("Álava", "Robos con violencia", 2024, 56)]
    assert got == sorted([("latin9.txt", *e) for e in expect] + [("utf8.txt", *e) for e in expect])


def test_stream_upsert_partition_scoped(spark, scratch):
    land = scratch("land2")
    rows = [(i % 9, (i % 9) % 3, f"2024-01-{1 + i % 28:02d} 00:00:00", i) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, p long, ts string, v long").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    df.repartition(5).write.parquet(land)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(land)
    root, ck = scratch("scoped"), scratch("ck3")
    I.upsert_batches(spark, stream, root, ck, ["k"], ["ts", "v"], partition_by=["p"])
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(root).collect())
    batch = df.groupBy("k").agg(F.max_by("v", F.struct("ts", "v")).alias("v"))
    assert got == sorted((r["k"], r["v"]) for r in batch.collect())


def test_point_in_polygon_holes_and_multipolygons(spark):
    from harmoniq.operators.spatial import assign_regions
    regions = spark.createDataFrame([
        ("A", '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}'),
        ("B", '{"type":"MultiPolygon","coordinates":[[[[10,10],[11,10],[11,11],[10,10]]],[[[20,0],[22,0],[22,2],[20,2],[20,0]]]]}'),
    ], "code string, geometry string")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 21.0, 1.0), (4, 10.8, 10.2), (5, 10.2, 10.8),
                                 (6, 50.0, 50.0)], "id long, lon double, lat double")
    got = {r["id"]: r["region_code"] for r in assign_regions(pts, regions, "id", cell=1.0).collect()}
    assert got == {1: "A", 2: None, 3: "B", 4: "B", 5: None, 6: None}
