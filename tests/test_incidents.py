"""Incident intake end to end (no network): envelopes -> merge -> geocode
-> confidence -> stable id -> upsert; URL dedupe."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from harmoniq.operators.articles import dedupe_by_url, normalize_url
from harmoniq.operators.incidents import envelope_records, finalize, merge_hard, with_hard_key
from harmoniq.operators.upsert import upsert
from harmoniq.session import to_local_path
from harmoniq.sources.files import read_jsonl_variant


def _write_outbox(path):
    a = {"date_incident": "2026-05-17", "date_reported": "2026-05-18", "country": "UK", "city": "Leicester",
         "weapon": "unknown", "victim_count": 1, "victim_fatal": 1, "suspect_description_verbatim": "",
         "location_precision": "exact",
         "sources": [{"url": "https://www.leics.police.uk/news/1", "outlet": "police"},
                     {"url": "", "outlet": "no url"}]}
    a2 = dict(a, date_reported="2026-05-17", victim_count=2, suspect_description_verbatim="a man, 30s",
              sources=[{"url": "https://news.example/a", "outlet": "news"},
                       {"url": "https://www.leics.police.uk/news/1", "outlet": "police again"}])
    b = {"date_incident": None, "date_reported": "2026-05-20", "country": "UK", "city": "Denton",
         "weapon": "unknown", "victim_fatal": 0, "sources": [{"url": "https://paper.example/x"}]}
    lines = [json.dumps({"extracted": True, "skip_reason": None, "incident": a}), "",
             json.dumps({"extracted": True, "incident": a2}),
             json.dumps({"extracted": False, "skip_reason": "not an incident", "incident": None}),
             json.dumps({"extracted": True, "incident": b}), "   "]
    os.makedirs(to_local_path(path), exist_ok=True)
    with open(os.path.join(to_local_path(path), "extracted_2026-05.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")


def _cache(spark):
    return spark.createDataFrame([("UK", "Leicester", "", 52.6362, -1.1332, "UKF21")],
                                 "country string, city string, region_hint string, lat double, lon double, nuts_code string")


def test_finalize_end_to_end(spark, scratch):
    path = scratch("outbox")
    _write_outbox(path)
    recs = envelope_records(read_jsonl_variant(spark, path))
    assert recs.count() == 3                                     # blank lines and extracted=false skipped
    out = finalize(recs, _cache(spark), "2026-06-01T00:00:00+00:00")
    rows = {r["city"]: r for r in out.collect()}
    assert len(rows) == 2 and len(out.columns) == 23
    lei, den = rows["Leicester"], rows["Denton"]
    assert lei["incident_id"] == "0cf53f4f-78b8-50bc-beff-47c9023b9f83"
    assert den["incident_id"] == "7af4f9cc-c86e-5838-bed6-395996c41e5c"   # JSON null date -> 'None'
    assert lei["confidence"] == "HIGH" and den["confidence"] == "LOW"
    assert lei["victim_count"] == 2 and lei["date_reported"] == "2026-05-17"
    assert lei["suspect_description_verbatim"] == "a man, 30s"
    assert [s["url"] for s in json.loads(lei["sources_json"])] == \
        ["https://www.leics.police.uk/news/1", "https://news.example/a"]
    assert (lei["lat"], lei["region_code"], lei["location_precision"]) == (52.6362, "UKF21", "exact")
    assert den["lat"] is None and den["location_precision"] == "city"
    from harmoniq.operators import quality as Q
    assert all(r["n_violations"] == 0 for r in Q.rule_counts(out, Q.incident_rules()).collect())   # Q5
    # second run of the same batch leaves two incidents
    again = upsert(out, finalize(recs, _cache(spark), "2026-06-02T00:00:00+00:00"), ["incident_id"])
    assert again.count() == 2


def test_single_record_group_passes_through(spark):
    rows = [(1, "2026-01-01", None, "FR", "Lyon", "knife", 1, 0, "", None,
             [("https://a.example/1", None, None, None), ("https://a.example/1", None, None, None), (None, "x", None, None)])]
    df = spark.createDataFrame(rows, "ordinal long, date_incident string, date_reported string, country string, "
                                     "city string, weapon string, victim_count long, victim_fatal long, "
                                     "suspect_description_verbatim string, suspect_origin_as_reported string, "
                                     "sources array<struct<url string, outlet string, published_at string, quote_snippet string>>")
    m = merge_hard(with_hard_key(df)).first()
    assert m["n_records"] == 1 and len(m["sources"]) == 3   # duplicates and url-less survive untouched


def test_dedupe_by_url_first_seen(spark):
    df = spark.createDataFrame([(1, 0, " https://a.example/x "), (2, 0, "https://a.example/x"), (3, 1, ""),
                                (4, 1, None), (5, 1, "http://a.example/x/?utm=1"), (0, 1, "https://b.example/")],
                               "id long, rank int, url string")
    got = sorted(r["id"] for r in dedupe_by_url(df, "url", ["rank", "id"]).collect())
    assert got == [0, 1, 5]
    got = sorted(r["id"] for r in dedupe_by_url(df, "url", ["rank", "id"], key=normalize_url("url")).collect())
    assert got == [0, 1]


def test_upsert_incidents_collapses_shared_ids(spark):
    from harmoniq.operators.incidents import upsert_incidents
    from harmoniq.schema import INCIDENT_COLUMNS
    cols = list(INCIDENT_COLUMNS)
    def row(iid, src, at):
        r = {c: None for c in cols}
        r.update(incident_id=iid, sources_json=src, extracted_at=at, review_status="unreviewed")
        return tuple(r[c] for c in cols)
    schema = ", ".join(f"{c} string" if c not in ("lat", "lon") and c not in (
        "victim_count", "victim_fatal", "suspect_count") else (f"{c} double" if c in ("lat", "lon") else f"{c} long")
        for c in cols)
    existing = spark.createDataFrame([row("a", "[]", "t0"), row("b", "[]", "t0")], schema)
    batch = spark.createDataFrame([row("a", '[{"url":"x"}]', "t1"), row("a", "[]", "t2")], schema)
    out = {r["incident_id"]: r for r in upsert_incidents(existing, batch).collect()}
    assert set(out) == {"a", "b"} and out["a"]["sources_json"] == '[{"url":"x"}]'


def test_jsonl_ordinals_follow_file_order_across_splits(spark, scratch):
    """(file, split start, in-split row id) orders lines as in the file even
    when one file is read as many splits."""
    path = scratch("split_jsonl")
    os.makedirs(to_local_path(path), exist_ok=True)
    with open(os.path.join(to_local_path(path), "big.jsonl"), "w") as f:
        for i in range(3000):
            f.write(json.dumps({"i": i, "pad": "x" * 40}) + "\n")
            if i % 97 == 0:
                f.write("\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        env = read_jsonl_variant(spark, path)
        assert env.rdd.getNumPartitions() > 4
        rows = env.select("block", "line_no", F.variant_get("v", "$.i", "int").alias("i")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    ordered = [r["i"] for r in sorted(rows, key=lambda r: (r["block"], r["line_no"]))]
    assert ordered == list(range(3000))
