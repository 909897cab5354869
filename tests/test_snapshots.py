"""Snapshot commits, sections over splits, late rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from harmoniq.operators import snapshots as P
from harmoniq.session import to_local_path
from harmoniq.streaming import intake as I


def rows_of(df):
    return sorted((r["country"] or "", r["k"], r["v"]) for r in df.collect())


def test_commits_and_readers(spark, scratch):
    root = scratch("snap")
    base = spark.createDataFrame([("FR", "a", 1), ("FR", "b", 2), ("DE", "a", 3), (None, "n", 4)], "country string, k string, v long")
    assert rows_of(P.read_snapshot(spark, root, base.schema)) == []
    assert P.upsert_snapshot(spark, root, base, ["country", "k"], ["country"], base.schema) == 1
    old = P.read_snapshot(spark, root, base.schema)
    batch = spark.createDataFrame([("FR", "a", 10), ("FR", "c", 30), (None, "n", 40)], base.schema)
    assert P.upsert_snapshot(spark, root, batch, ["country", "k"], ["country"], base.schema) == 2
    want = [("", "n", 40), ("DE", "a", 3), ("FR", "a", 10), ("FR", "b", 2), ("FR", "c", 30)]
    assert rows_of(P.read_snapshot(spark, root, base.schema)) == want
    assert rows_of(old) == rows_of(base)                       # a reader keeps what it has resolved
    assert rows_of(P.read_snapshot(spark, root, base.schema, 1)) == rows_of(base)
    held = P._partitions(spark, root, 2)
    assert held["country=DE"].startswith("commit=00000001") and held["country=FR"].startswith("commit=00000002")
    pruned = P.read_snapshot(spark, root, base.schema).filter("country = 'DE'")
    assert "PartitionFilters: [isnotnull(country" in pruned._jdf.queryExecution().executedPlan().toString()
    assert rows_of(pruned) == [("DE", "a", 3)]


def test_a_write_that_is_cut_off_changes_nothing(spark, scratch):
    root = scratch("snap")
    base = spark.createDataFrame([(f"C{i % 4}", f"k{i}", i) for i in range(40)], "country string, k string, v long")
    P.upsert_snapshot(spark, root, base, ["country", "k"], ["country"], base.schema)
    before = rows_of(P.read_snapshot(spark, root, base.schema))
    bad = base.withColumn("v", F.when(F.col("k") == "k33", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v") + 1))
    with pytest.raises(Exception, match="lost"):
        P.upsert_snapshot(spark, root, bad, ["country", "k"], ["country"], base.schema)

    def stop():
        raise RuntimeError("refused")
    with pytest.raises(RuntimeError, match="refused"):          # all is written, the pointer is not
        P.upsert_snapshot(spark, root, base.withColumn("v", F.col("v") + 1), ["country", "k"], ["country"], base.schema, check=stop)
    assert rows_of(P.read_snapshot(spark, root, base.schema)) == before and P.pointers(spark, root) == [1]
    assert len(glob.glob(to_local_path(root) + "/commit=*")) >= 2
    assert P.upsert_snapshot(spark, root, base.withColumn("v", F.col("v") + 1), ["country", "k"], ["country"], base.schema) == 2
    assert rows_of(P.read_snapshot(spark, root, base.schema)) == [(c, k, v + 1) for c, k, v in before]


def test_two_writers_from_one_pointer(spark, scratch):
    root = scratch("snap")
    base = spark.createDataFrame([("A", "a", 1)], "country string, k string, v long")
    P.commit(spark, root, base, ["country"])
    assert P.commit(spark, root, base.withColumn("country", F.lit("B")), ["country"], base=1) == 2
    with pytest.raises(P.Conflict):
        P.commit(spark, root, base.withColumn("country", F.lit("C")), ["country"], base=1)
    assert rows_of(P.read_snapshot(spark, root, base.schema)) == [("A", "a", 1), ("B", "a", 1)]


def test_snapshot_stream_again_from_the_start(spark, scratch):
    """A second pass with a fresh checkpoint brings old rows again: newer ones stay."""
    land, root = scratch("land"), scratch("snap")
    df = spark.createDataFrame([(i % 9, (i % 9) % 3, dt.datetime(2024, 1, 1 + i % 28), i) for i in range(80)],
                               "k long, p long, ts timestamp_ntz, v long")
    df.repartition(5).write.parquet(land)
    for _ in range(2):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(land)
        I.snapshot_batches(spark, stream, root, scratch("ck"), ["k"], ["ts", "v"], ["p"])
    got = sorted((r["k"], r["v"]) for r in P.read_snapshot(spark, root, df.schema).collect())
    want = df.groupBy("k").agg(F.max_by("v", F.struct("ts", "v")).alias("v"))
    assert got == sorted((r["k"], r["v"]) for r in want.collect()) and P.pointers(spark, root)[-1] >= 6


# ---- late rows -------------------------------------------------------------------------------
SCHEMA = "id long, k string, ts timestamp_ntz"


def by_hand(batches, delay):
    newest, held, out = None, [], []
    for n, batch in enumerate(batches):
        mark = newest - delay if newest else None
        firsts = {}
        for i, k, ts in batch:
            if ts is None or (mark and ts < mark):
                out.append((i, "late", n))
            else:
                firsts[k] = min(firsts.get(k, (ts, i)), (ts, i))
        still = {k for k, ts in held if not mark or ts >= mark - delay}
        for k, (ts, i) in firsts.items():
            if k not in still:
                out.append((i, "kept", n))
        held += [(k, ts) for k, (ts, _) in firsts.items() if k not in still]
        newest = max([t for _, _, t in batch if t] + ([newest] if newest else []), default=None)
    return sorted(out)


def run_late(spark, scratch, batches, cuts):
    land, root, ck = scratch("land"), scratch("out"), scratch("ck")
    at = 0
    for stop in cuts:                                            # each run goes on from the checkpoint
        for b in batches[at:stop]:
            spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(land)
        at = stop
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(land)
        I.dedupe_with_late(spark, stream, root, ck, ["k"], "ts", "id", 2)
    out = []
    for name in ("kept", "late"):
        out += [(r["id"], name, r["batch"]) for r in spark.read.schema("id long, batch long").parquet(f"{root}/{name}").collect()]
    clock = spark.read.parquet(f"{root}/clock").orderBy("batch").collect()
    return sorted(out), clock


def test_late_rows_over_batches_and_restarts(spark, scratch):
    rnd = random.Random(2)
    day = dt.datetime(2024, 1, 1)
    batches = [[(100 * b + i, f"k{rnd.randrange(9)}", day + dt.timedelta(days=b, hours=rnd.randrange(24) - 24 * rnd.choice((0, 0, 1, 4))))
                for i in range(30)] for b in range(6)]
    batches[3] += [(399, "k1", None)]
    want = by_hand(batches, dt.timedelta(days=2))
    assert {f for _, f, _ in want} == {"kept", "late"}
    for cuts in ((6,), (2, 6)):
        got, clock = run_late(spark, scratch, batches, cuts)
        assert got == want
        assert [r["rows_in"] for r in clock] == [len(b) for b in batches]
        assert all(r["rows_in"] == r["late"] + r["kept"] + r["duplicates"] and r["duplicates"] >= 0 for r in clock)


# ---- sections over splits ----------------------------------------------------------------------
def plain_sections(text):
    lines = text.replace("\r\n", "\n").split("\n")
    at, years = next((i, [p.strip() for p in ln.split("\t") if p.strip().isdigit() and len(p.strip()) == 4])
                     for i, ln in enumerate(lines) if any(p.strip().isdigit() and len(p.strip()) == 4 for p in ln.split("\t")))
    section, out = "", []
    for ln in lines[at + 1:]:
        if ln[:1] in (" ", "\t"):
            label, *vals = ln.split("\t")
            if label.strip():
                out += [(section, label.strip(), int(y), vals[i] if i < len(vals) else None) for i, y in enumerate(years)]
        elif ln.strip(" "):
            section = ln.rstrip("\t").strip(" ")
    return out


@pytest.mark.parametrize("split", [64, 300, 1 << 20])
def test_sections_are_carried_across_splits(spark, scratch, split):
    """The open section reaches lines any number of splits below its header."""
    from harmoniq.sources.shapes import read_sections
    root = to_local_path(scratch("sections"))
    os.makedirs(root)
    rnd = random.Random(8)
    texts = {}
    for name, end in (("a", "\n"), ("b", "\r\n"), ("latin", "\n")):
        body = ["Title", f"Región {name}\t", "\t2021\t2022", "   before any section\t1\t2"]
        for s in range(9):
            body += [f"Province of Ñ{s}\t\t", *([""] * (s % 2))]
            body += [f"    label {i}\t{rnd.randrange(9999)}\t{rnd.randrange(99)}\t9" for i in range(rnd.choice((0, 1, 40)))]
        texts[name] = end.join(body) + end
        with open(f"{root}/{name}.txt", "w", encoding="iso-8859-15" if name == "latin" else "utf-8", newline="") as f:
            f.write(texts[name])
    conf = spark.conf
    was = {k: conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        conf.set("spark.sql.files.maxPartitionBytes", str(split))
        conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_sections(spark, root)
        got = [(os.path.basename(r["file"])[:-4], r["section"], r["label"], r["year"], r["raw_value"]) for r in df.collect()]
    finally:
        for k, v in was.items():
            conf.set(k, v)
    want = [(n, *row) for n, t in texts.items() for row in plain_sections(t)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert "binaryFile" not in df._jdf.queryExecution().toString()


# ---- the geocode log and the manifest -----------------------------------------------------------
def test_geocode_log_newest_answer_wins(spark, scratch):
    from harmoniq.operators import geocode_cache as G
    root = scratch("geo")
    old = spark.createDataFrame([("de", " Köln ", "50.9", "6.9", "DEA"), ("FR", "Lyon", "", "", "")],
                                "country string, city string, lat string, lon string, nuts_code string")
    assert G.read_cache(spark, root).count() == 0
    assert G.append_resolved(spark, root, old) == 1                  # no hint column: an older file
    new = spark.createDataFrame([("FR", "LYON", None, 45.7, 4.8, "FRK"), ("DE", "köln", "NRW", 51.0, 7.0, "DEA2"),
                                 ("DE", "köln", "NRW", None, None, None)],
                                "country string, city string, region_hint string, lat double, lon double, nuts_code string")
    assert G.append_resolved(spark, root, new) == 2

    def rows():
        return sorted(tuple(r) for r in G.read_cache(spark, root).collect())
    want = [("DE", "köln", "", 50.9, 6.9, "DEA"), ("DE", "köln", "nrw", 51.0, 7.0, "DEA2"), ("FR", "lyon", "", 45.7, 4.8, "FRK")]
    assert rows() == want
    assert G.compact(spark, root) == 3 and rows() == want and len(P._partitions(spark, root, 3)) == 1
    G.append_resolved(spark, root, new.filter("lat is null").withColumn("region_hint", F.lit(" nrw")))
    assert rows()[1] == ("DE", "köln", "nrw", None, None, None)       # not found any more: the newest answer


def test_manifest_reads_only_the_partitions_of_the_batch(spark, scratch):
    root = scratch("manifest")
    known = spark.range(400).select(F.concat(F.lit("f"), F.col("id")).alias("path"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    known.withColumn("prefix", F.left("sha256", F.lit(2))).repartition("prefix").write.partitionBy("prefix").parquet(root)
    batch = spark.createDataFrame([(399,), (1000,)], "id long").select(
        F.concat(F.lit("f"), F.col("id")).alias("path"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    fresh = I.manifest_lookup(spark, root, batch)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [prefix" in plan and "InMemoryFileIndex" in plan
    assert [r["path"] for r in fresh.collect()] == ["f1000"]
    assert I.manifest_lookup(spark, scratch("none"), batch).count() == 2
