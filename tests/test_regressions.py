"""Cases that once lost data or ended a job."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harmoniq.functions.text import digits_only_long
from harmoniq.functions.urls import url_domain
from harmoniq.operators import harmonise as H
from harmoniq.operators.upsert import upsert_partitions
from harmoniq.streaming.intake import upsert_batches
from tests.conftest import SF_SMALL


def test_partition_upsert_leaves_other_partitions_alone(spark, scratch):
    path = scratch("parts")
    cols = "country string, code string, n int"
    spark.createDataFrame([("FR", "a", 1), ("DE", "b", 10)], cols).write.partitionBy("country").parquet(path)
    staging = path + "_staging"
    for rows in ([("DE", "b", 99)], [("IT", "c", 5), ("FR", "a", 2)]):
        upsert_partitions(spark, path, spark.createDataFrame(rows, cols), ["country", "code"], ["country"], staging=staging)
    got = {(r["country"], r["n"]) for r in spark.read.parquet(path).collect()}
    assert got == {("FR", 2), ("DE", 99), ("IT", 5)}


def test_empty_first_source_and_junk_counts(spark, scratch):
    dims = spark.createDataFrame([("FR", 1000)], "code string, population_latest long")
    rows = spark.createDataFrame([("A", "12.0", "2020"), ("A", "n/a", "2020"), ("A", "3", "2020p")],
                                 "cat string, n string, year string")
    spec = H.SourceSpec(country="FR", authority="a", url="u", category_map=[("A", "homicide")], native_category="cat",
                        count="n", year="year", retention="all")
    path = scratch("table")
    as_of = dt.datetime(2026, 1, 1)
    runs = H.run_sources(spark, [("none", rows.limit(0), spec), ("some", rows, spec)], dims, path, as_of=as_of).collect()
    assert [(r["source"], r["status"], r["n_rows"] > 0) for r in runs] == [("none", "ok", False), ("some", "ok", True)]
    assert spark.read.parquet(path).filter("count = 12").count() == 1


def test_stream_with_a_new_checkpoint_adds_a_version(spark, scratch):
    root = scratch("versions")
    for value in (20, 30):
        land = scratch("land")
        spark.createDataFrame([("k", value, value)], "id string, v int, seq int").write.parquet(land)
        stream = spark.readStream.schema("id string, v int, seq int").parquet(land)
        upsert_batches(spark, stream, root, scratch("ckpt"), ["id"], ["seq"])
    from harmoniq.operators.upsert import read_version
    assert [r["v"] for r in read_version(spark, root).collect()] == [30]
    assert [r["v"] for r in read_version(spark, root, 1).collect()] == [20]


@pytest.mark.parametrize("url,host", [
    ("https://my_site.example.com/a", "my_site.example.com"), ("https://www.example.com/a b|c{1}%zz", "example.com"),
    ("http://user:pw@Host.example.org:8080/x", "host.example.org"), ("no scheme", ""), ("", ""), (None, "")])
def test_url_domain_of_urls_a_strict_parser_refuses(spark, url, host):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(url_domain("u").alias("d")).first()["d"] == host


def test_too_long_number_is_missing(spark):
    df = spark.createDataFrame([("1" * 20,), ("1.234",)], "x string")
    assert [r[0] for r in df.select(digits_only_long("x")).collect()] == [None, 1234]


def test_section_file_without_a_year_header_fails(spark, scratch):
    from harmoniq.sources.shapes import read_sections
    path = scratch("sections")
    spark.createDataFrame([("Title\n row\t1\t2\n",)], "value string").write.text(path)
    with pytest.raises(Exception, match="no year header"):
        read_sections(spark, f"{path}/*.txt").collect()


def test_invalid_source_is_refused_as_a_whole(spark, scratch):
    dims = spark.createDataFrame([("FR", 1000)], "code string, population_latest long")
    cols = "cat string, n long, year int, unit string"
    good = spark.createDataFrame([("A", 7, 2020, "x")], cols)
    bad = spark.createDataFrame([("A", -1, 2019, "x"), ("B", 4, 2019, "x"), ("A", 5, 2020, "x"), ("A", 5, 2020, "y")], cols)
    base = dict(country="FR", authority="a", url="u", native_category="cat", count="n", year="year", retention="all")
    sources = [("good", good, H.SourceSpec(category_map=[("A", "homicide")], **base)),
               ("bad", bad, H.SourceSpec(category_map=[("A", "homicide"), ("B", "theft")], group_extra=["unit"], **base))]
    path = scratch("refused")
    runs = {r["source"]: r for r in H.run_sources(spark, sources, dims, path, as_of=dt.datetime(2026, 1, 1)).collect()}
    assert (runs["good"]["status"], runs["bad"]["status"], runs["bad"]["n_rows"]) == ("ok", "failed", 0)
    assert runs["bad"]["error"] == "count_non_negative: 1 rows; crime_category_enum: 1 rows; repeated keys: 1"
    assert [(r["count"], r["crime_category"]) for r in spark.read.parquet(path).collect()] == [(7, "homicide")]


def test_blank_and_null_are_one_key_value(spark):
    from harmoniq.operators.quality import duplicate_keys
    df = spark.createDataFrame([("a", ""), ("a", None), ("b", ""), ("c", "x")], "k string, v string")
    assert [tuple(r) for r in duplicate_keys(df, ["k", "v"], blank_is_null=True).collect()] == [("a", None, 2)]
    assert duplicate_keys(df, ["k", "v"]).count() == 0


def test_finalize_keeps_what_a_record_supplies(spark, scratch):
    import json
    from harmoniq.operators.incidents import envelope_records, finalize
    from harmoniq.sources.files import read_jsonl_variant
    base = {"country": "DE", "city": "Ulm", "weapon": "knife", "state": "BW", "victim_fatal": 0}
    given = [dict(base, date_incident="2026-01-01", region_code="DE1", review_status="reviewed", extractor_version="own@2",
                  extracted_at="2025-12-31", last_reviewed_at="2026-01-02"),
             dict(base, date_incident="2026-01-02", region_code="DE1", lat=None),
             dict(base, date_incident="2026-01-03", lat=1.0, lon=None)]
    path = scratch("supplied")
    spark.createDataFrame([(json.dumps({"extracted": True, "incident": g}),) for g in given], "value string") \
        .coalesce(1).write.text(path)
    cache = spark.createDataFrame([("DE", "Ulm", "BW", 48.4, 10.0, "DE144")],
                                  "country string, city string, region_hint string, lat double, lon double, nuts_code string")
    rows = sorted(finalize(envelope_records(read_jsonl_variant(spark, path)), cache, "now").collect(),
                  key=lambda r: r["date_incident"])
    assert [(r["lat"], r["lon"], r["region_code"]) for r in rows] == [
        (48.4, 10.0, "DE1"), (48.4, 10.0, "DE144"), (1.0, None, "DE144")]
    assert [(r["review_status"], r["extractor_version"], r["extracted_at"], r["last_reviewed_at"]) for r in rows] == [
        ("reviewed", "own@2", "2025-12-31", "2026-01-02"), *[("unreviewed", "manual@prompt-v1", "now", None)] * 2]


def test_history_documents_are_ordered_and_keep_nulls(spark):
    from harmoniq.operators.views import nested_history, with_derived_total
    h = spark.createDataFrame([("R1", 2021, "robbery_violent", None, 2.0), ("R1", 2021, "homicide", 5, 1.5),
                               ("R1", 2020, "violent_total", 1, None)],
                              "region_code string, yr int, crime_category string, count long, rate double")
    assert nested_history(with_derived_total(h)).first()["history_json"] == (
        '{"2020":{"violent_total":{"count":1,"rate":null}},'
        '"2021":{"homicide":{"count":5,"rate":1.5},"robbery_violent":{"count":null,"rate":2.0},'
        '"violent_total":{"count":5,"rate":3.5,"derived":true}}}')


def test_a_version_whose_write_was_cut_off_is_not_read(spark, scratch):
    from harmoniq.operators.upsert import newest_version, read_version, write_version
    root = scratch("cut")
    write_version(spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "id string, v int, seq int"), root, 1)
    spark.createDataFrame([("a", 7, 2)], "id string, v int, seq int").write \
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/version=2")
    assert newest_version(spark, root) == 1 and newest_version(spark, root, complete=False) == 2
    land = scratch("cut_land")
    spark.createDataFrame([("a", 9, 3)], "id string, v int, seq int").write.parquet(land)
    upsert_batches(spark, spark.readStream.schema("id string, v int, seq int").parquet(land), root, scratch("cut_ckpt"),
                   ["id"], ["seq"])
    assert newest_version(spark, root) == 3
    assert sorted((r["id"], r["v"]) for r in read_version(spark, root).collect()) == [("a", 9), ("b", 2)]


def _calls(monkeypatch, module, name):
    made, was = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: made.append(name) or was(*a, **k))
    return made


def test_release_names_are_read_per_file(spark):
    """the rows of the landed files are not parsed for their release."""
    from harmoniq.sources.shapes import pick_release
    landed = spark.range(100).selectExpr("id", "concat('tables-yearending-', if(id % 2 = 0, 'june', 'march'), '-2020.csv') AS name")
    got = pick_release(landed, "2020-08-01")
    assert "regexp_extract" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == ["id", "name", "release_end"] and got.filter("id % 2 = 0").count() == got.count() == 50


def test_incidents_are_finished_once(spark, monkeypatch):
    """the refused batch takes the finished incidents that are stored already."""
    from harmoniq.plans import QUERIES, incidents_q, load_all
    load_all()
    made = _calls(monkeypatch, incidents_q, "finalized")
    got = QUERIES["incident_table"](spark, SF_SMALL)
    assert got.filter("refused = 1").count() > 0 and made == ["finalized"]


def test_sources_of_a_registry_share_their_lines(spark, monkeypatch):
    """the line joins run once for all sources of a run."""
    from harmoniq.plans import QUERIES, adapters_q, load_all
    load_all()
    made = _calls(monkeypatch, adapters_q, "_lines")
    assert QUERIES["registry_table"](spark, SF_SMALL).count() > 0 and made == ["_lines"]
