"""Dimension upkeep, quality samples, exports, feed records, clustering,
release selection."""

from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F

from harmoniq.operators import quality as Q
from harmoniq.operators.cluster import grid_clusters
from harmoniq.operators.dims import patch_attributes, replace_rows, unknown_patch_codes, with_hierarchy
from harmoniq.sources import exports as X
from harmoniq.sources.shapes import pick_release

DIM = ("code string, name_en string, population_latest long, area_km2 double, "
       "centroid_lat double, centroid_lon double")


def test_patch_replace_and_hierarchy(spark):
    dim = spark.createDataFrame([("ES", "Spain", 1, None, 40.0, -3.0), ("ES5", "East", None, None, None, None)], DIM)
    patch = spark.createDataFrame([("ES", None, 9, 5.0, 1.0, 1.0), ("ES5", None, 7, None, 39.5, -0.5),
                                   ("ZZ9", None, 3, None, None, None)], DIM)
    got = {r["code"]: r for r in patch_attributes(dim, patch).collect()}
    assert (got["ES"]["population_latest"], got["ES"]["area_km2"], got["ES"]["centroid_lat"]) == (9, 5.0, 40.0)
    assert (got["ES5"]["centroid_lat"], got["ES5"]["centroid_lon"]) == (39.5, -0.5)   # filled only where null
    assert [r["code"] for r in unknown_patch_codes(dim, patch).collect()] == ["ZZ9"]
    rows = spark.createDataFrame([("ES5", "Este", 2, None, None, None)], DIM)
    rep = {r["code"]: r["name_en"] for r in replace_rows(dim, rows).collect()}
    assert rep == {"ES": "Spain", "ES5": "Este"}
    h = with_hierarchy(dim).orderBy("code").collect()
    assert [(r["level"], r["parent_code"], r["country"]) for r in h] == [(0, None, "ES"), (1, "ES", "ES")]


def test_violation_samples_are_smallest_keys(spark):
    df = spark.range(0, 5000).withColumn("v", F.col("id") % 7)
    rules = [("seven", F.col("v") == 0), ("odd", F.col("id") % 2 == 1)]
    got = {r["rule"]: (r["n_violations"], r["sample"]) for r in Q.violation_samples(df, rules, "id", 5).collect()}
    assert got["seven"] == (715, [0, 7, 14, 21, 28])
    assert got["odd"] == (2500, [1, 3, 5, 7, 9])


def test_point_features_and_bad_sources(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, '[{"url": "https://x.example/1"}]'), ("b", None, 2.0, "[]"),
                                ("c", 3.0, 4.0, "not json")], "id string, lon double, lat double, s string")
    feats = [json.loads(r["feature"]) for r in X.point_features(df, "lon", "lat", ["id"], "s").collect()]
    assert [f["properties"]["id"] for f in feats] == ["a", "c"]              # P23: located only
    assert feats[0]["geometry"] == {"type": "Point", "coordinates": [1.0, 2.0]}
    assert feats[0]["properties"]["sources"][0]["url"] == "https://x.example/1"
    assert feats[1]["properties"]["sources"] == []                          # bad JSON -> []
    coll = X.feature_collections(X.point_features(df, "lon", "lat", ["id"]).withColumn("g", F.lit(1)), "g").first()
    assert len(json.loads(coll["document"])["features"]) == 2


def test_feed_records(spark):
    entries = spark.createDataFrame([
        ("https://n.example/1", "T1", "<p>Lead <b>one</b></p>\n", "desc", "2026-05-01", "2026-05-02", "UK", "n"),
        ("https://n.example/2", "T2", None, "<i>only desc</i>", None, "Sun, 3 May 2026 23:30:00 -0200", "UK", "n"),
        ("https://n.example/3", "T3", None, None, "soon", "4 May 2026 10:15 GMT", "UK", "n"),
        ("https://n.example/4", "T4", None, None, "2026-05-04T10:15:00+02:00", None, "UK", "n"),
        ("https://n.example/5", "T5", None, None, "2026-05-04 10:15:00", None, "UK", "n"),
        ("https://n.example/6", "T6", None, None, None, "never", "UK", "n"),
        (None, "no link", "x", "y", "2026-05-01", None, "UK", "n")], X.RSS_ENTRY)
    zone = spark.conf.get("spark.sql.session.timeZone")
    for session_zone in (zone, "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            got = [(r["url"][-1], r["lead"], r["published_at"]) for r in X.rss_articles(entries).orderBy("url").collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        assert got == [("1", "Lead  one", "2026-05-01T00:00:00+00:00"), ("2", "only desc", "2026-05-04T01:30:00+00:00"),
                       ("3", "", "2026-05-04T10:15:00+00:00"), ("4", "", "2026-05-04T08:15:00+00:00"),
                       ("5", "", "2026-05-04T10:15:00+00:00"), ("6", "", None)]
    docs = spark.createDataFrame([([("https://g.example/a", "Title", "20260501T101500Z", "g.example", "English", "UK"),
                                    ("https://g.example/b", None, "20260501T101500Z", None, "", "Germany"),
                                    ("https://g.example/c", "T", None, "", None, "France")],)], X.GDELT_DOC)
    a, b, c = X.gdelt_articles(docs, F.lit("UK")).orderBy("url").collect()
    assert (a["outlet"], a["published_at"], a["language"], a["source"]) == ("g.example", "20260501T101500Z", "english", "gdelt")
    assert (b["outlet"], b["language"], b["title"], c["outlet"], c["published_at"]) == ("Germany", None, "", "France", None)
    assert X.gdelt_articles(docs, F.lit("UK"), iso_dates=True).orderBy("url").first()["published_at"] == "2026-05-01T10:15:00+00:00"


def test_incident_features_keep_nulls(spark):
    from harmoniq.schema import INCIDENT_COLUMNS
    row = {c: None for c in INCIDENT_COLUMNS} | {"incident_id": "i", "lat": 0.0, "lon": 9.5, "sources_json":
                                                 '[{"url": "u", "outlet": null, "lang": "de"}]', "victim_count": 2}
    kinds = {"lat": "double", "lon": "double", "victim_count": "long"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in INCIDENT_COLUMNS)
    rows = [row, row | {"incident_id": "bad", "sources_json": "[{"}, row | {"incident_id": "none", "lat": None}]
    got = [json.loads(r["feature"]) for r in X.incident_features(
        spark.createDataFrame([tuple(r[c] for c in INCIDENT_COLUMNS) for r in rows], schema)).collect()]
    assert [f["properties"]["incident_id"] for f in got] == ["i", "bad"]
    p = got[0]["properties"]
    assert len(p) == 15 and p["city"] is None and p["lat"] == 0.0 and "sources_json" not in p
    assert p["sources"] == [{"url": "u", "outlet": None, "lang": "de"}] and got[1]["properties"]["sources"] == []


def test_sources_keep_nulls_and_unknown_keys(spark, scratch):
    from harmoniq.operators.incidents import envelope_records, finalize
    from harmoniq.sources.files import read_jsonl_variant
    path = scratch("env")
    lines = [{"extracted": True, "incident": {"date_incident": "2026-01-02", "country": "DE", "city": c, "weapon": "knife", "victim_fatal": 0,
                                              "sources": s}} for c, s in
             (("A", [{"url": "https://x.example/1", "outlet": None, "lang": "de"}]), ("B", []), ("C", None),
              ("D", [{"url": "https://x.example/1", "n": 1}, {"url": "https://y.example/2"}]),
              ("D", [{"url": "https://x.example/1", "n": 2}, {"outlet": "no url"}, {"url": "https://z.example/3", "k": None}]))]
    spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(path)
    cache = spark.createDataFrame([], "country string, city string, region_hint string, lat double, lon double, nuts_code string")
    done = {r["city"]: json.loads(r["sources_json"]) for r in finalize(envelope_records(read_jsonl_variant(spark, path)), cache, "t").collect()}
    assert done == {"A": [{"url": "https://x.example/1", "outlet": None, "lang": "de"}], "B": [], "C": [],
                    "D": [{"url": "https://x.example/1", "n": 1}, {"url": "https://y.example/2"}, {"url": "https://z.example/3", "k": None}]}


def test_json_lines_keep_nulls(spark, scratch):
    path = scratch("jsonl")
    X.write_jsonl(spark.createDataFrame([("ä", None)], "a string, b string"), path)
    assert [json.loads(r["value"]) for r in spark.read.text(path).collect()] == [{"a": "ä", "b": None}]


def test_grid_clusters_counts_and_badges(spark):
    pts = spark.createDataFrame([(0.0, 0.0)] * 12 + [(100.0, 50.0)] * 3, "lon double, lat double")
    g = grid_clusters(pts, max_zoom=2)
    z0 = sorted((r["n"], r["badge"]) for r in g.filter("zoom = 0").collect())
    assert z0 == [(3, 0), (12, 2)]
    assert g.groupBy("zoom").agg(F.sum("n").alias("s")).filter("s != 15").count() == 0


def test_pick_release(spark):
    landed = spark.createDataFrame([("crime_year_ending_march_2026.xlsx",), ("crime_year_ending_december_2025.xlsx",),
                                    ("crime_year_ending_june_2026.xlsx",), ("readme.txt",)], "name string")
    got = [r["name"] for r in pick_release(landed, "2026-05-10").collect()]
    assert got == ["crime_year_ending_march_2026.xlsx"]        # June 2026 is not yet a candidate


def test_group_documents_round_trip(spark):
    df = spark.createDataFrame([("R1", "R1A", 2.0), ("R1", "R1B", None), ("R2", "R2C", 1.5)],
                               "country string, region_code string, rate double")
    docs = X.group_documents(df, "country", ["region_code"])
    d = {r["country"]: json.loads(r["document"]) for r in docs.collect()}
    assert [x["region_code"] for x in d["R1"]] == ["R1A", "R1B"]
    back = X.flatten_documents(docs, df.schema)
    assert sorted(tuple(r) for r in back.select("country", "region_code", "rate").collect()) == \
        sorted(tuple(r) for r in df.collect())


def test_documents_from_parts(spark, scratch):
    """A group that holds most rows becomes many parts of bounded size, in order."""
    rows = [("big", i, json.dumps({"i": i, "t": "x" * (i % 50)})) for i in range(3000)] + [("small", 1, '{"i":1}'), (None, 2, '{"i":2}')]
    rows += [("big", 7, '{"i":7,"t":"' + "y" * 5000 + '"}')]                       # longer than a part
    parts = X.document_parts(spark.createDataFrame(rows, "g string, o int, e string"), "g", ["o"], "e", part_bytes=2000)
    got = {}
    for r in parts.orderBy("g", "part").collect():
        assert len(r["text"]) <= 2000 + 100 or r["n"] <= 40 and "yyy" in r["text"]
        got.setdefault(r["g"], []).append(r)
    assert all([r["part"] for r in p] == list(range(1, len(p) + 1)) for p in got.values()) and len(got["big"]) > 30
    whole = json.loads("[" + ",".join(r["text"] for r in got["big"]) + "]")
    assert [x["i"] for x in whole] == sorted([r[1] for r in rows if r[0] == "big"])
    assert [json.loads(f"[{got[g][0]['text']}]") for g in ("small", None)] == [[{"i": 1}], [{"i": 2}]]
    path = scratch("docs")
    X.write_documents(spark, parts.filter("g is not null"), "g", path)
    back = X.part_elements(X.read_documents(spark, path, "g"), "struct<i:int, t:string>")
    assert back.groupBy("g").count().collect() and back.count() == 3002
    import glob
    import os

    from harmoniq.session import to_local_path
    os.remove(sorted(glob.glob(to_local_path(path) + "/parts/g=big/*.txt"))[0])
    with pytest.raises(ValueError, match="missing"):
        X.read_documents(spark, path, "g")
