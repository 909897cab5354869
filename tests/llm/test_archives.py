"""Packages, whitening and manifest against plain in-memory forms, and edge cases."""

from __future__ import annotations

import hashlib
import json
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from harmoniq.llm import merkle, warc_zip, whitening

ROW = "doc_id long, text string, lang string, pos long, node string, run string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def plain_proof(levels, at, arity):
    out = []
    for level in levels[:-1]:
        run = level[at // arity * arity:at // arity * arity + arity]
        out.append(run[:at % arity] + run[at % arity + 1:])
        at //= arity
    return out


def by_hand(rows, arity):
    """{(doc_id, leaf): list of (subroot, root, path, run_path)} of all rows."""
    runs = {}
    for doc_id, text, lang, *_ in rows:
        leaf = sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, text)))
        runs.setdefault("0" if lang is None else "1" + lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    order = sorted(runs, key=lambda r: r.encode())
    trees = {r: plain_tree([x[2] for x in sorted(runs[r])], arity) for r in order}
    over = plain_tree([trees[r][-1][0] for r in order], arity)
    out = {}
    for k, r in enumerate(order):
        for at, x in enumerate(sorted(runs[r])):
            out.setdefault((x[3], x[2]), []).append(
                (trees[r][-1][0], over[-1][0], plain_proof(trees[r], at, arity), plain_proof(over, k, arity)))
    return out


@pytest.mark.parametrize("arity,every", [(2, 1), (2, 2), (3, 2)])
def test_proofs_equal_a_plain_tree(spark, arity, every):
    rows = [(i, f"t{i % 5}", ["en", "de", None, ""][i % 4] if i % 3 else "en", 7, "n", "r") for i in range(57)]
    rows += [(60, "one alone", "xx", 1, "n", "r")]
    rows += [(None, None, "en", None, None, None)] * 2 + [(3, "t3", "en", 0, "x", "y")] * 9     # ties and repeats
    df = spark.createDataFrame(rows, ROW)
    m = merkle.manifest(df, "lang", "doc_id", merkle.leaf_digest(F.col("doc_id"), F.col("text")),
                        ["doc_id", merkle.leaf_digest(F.col("doc_id"), F.col("text")).alias("leaf")], arity, every)
    p = merkle.proofs(m)
    end = merkle.fold(merkle.fold(F.col("leaf"), F.col("pos"), F.col("path"), arity), F.col("run_pos"),
                      F.col("run_path"), arity)
    bad = merkle.fold(merkle.fold(F.lit("0" * 64), F.col("pos"), F.col("path"), arity), F.col("run_pos"),
                      F.col("run_path"), arity)
    got = {}
    for r in p.select("*", end.alias("end"), bad.alias("bad")).collect():
        assert r["end"] == r["root"] != r["bad"]
        got.setdefault((r["doc_id"], r["leaf"]), []).append((r["subroot"], r["root"], r["path"], r["run_path"]))
    want = by_hand(rows, arity)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    # only every ``every``-th level is stored
    assert len(m.tree.levels) == 1 + -(-merkle.height(max(sum(1 for r in rows if r[2] == x) for x in ("en", "de")),
                                                      arity) // every)


def test_manifest_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame([(1, "x", None, 0, "a", "b")], ROW)
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("text"))
    none = merkle.manifest(df.limit(0), "lang", "doc_id", leaf, ["doc_id"])
    assert none.root is None and merkle.proofs(none).count() == 0
    one = merkle.manifest(df, "lang", "doc_id", leaf, ["doc_id"])
    got = merkle.proofs(one).collect()
    assert [(r["doc_id"], r["path"], r["run_path"]) for r in got] == [(1, [], [])]
    assert one.root == got[0]["subroot"] == sha("1:11:x")
    with pytest.raises(ValueError):
        merkle.manifest(df, "lang", "doc_id", leaf, ["doc_id"], arity=1)


def test_long_texts_and_separators(spark):
    """Lengths keep neighbouring values apart; a text beyond 1 MB is hashed whole."""
    long = "äb " * 700_000
    df = spark.createDataFrame([(1, long, "en", 0, "", ""), (2, "1:2", "en", 0, "", ""), (21, ":2", "en", 0, "", "")], ROW)
    got = [r[0] for r in df.select(merkle.leaf_digest(F.col("doc_id"), F.col("text"))).collect()]
    assert got[0] == sha(f"1:1{len(long.encode())}:{long}") and len(set(got)) == 3


# ---- 11 --------------------------------------------------------------------------------
PAGE = "page_id long, url string, html string, digest string, size long, path string, key string"


def package_dir(tmp_path, name, build, **limits):
    """A package made by the standard library's writer."""
    path = str(tmp_path / name)
    with pytest.MonkeyPatch.context() as p:
        for k, v in limits.items():
            p.setattr(zipfile, k, v)
        with zipfile.ZipFile(path, "w") as z:
            build(z)
    return path


def standard(z, records, method=zipfile.ZIP_STORED, index_method=zipfile.ZIP_DEFLATED, count=0,
             comment=b"a comment"):
    data, lines = b"", []
    for payload in records:
        block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + payload
        packed = warc_zip.gzip_member(warc_zip.warc_record([("WARC-Type", "response"), ("WARC-Record-ID", "<u:1>"),
                                                           ("Content-Type", "application/http")], block))
        lines.append(f"k 1 {json.dumps({'filename': 'd.warc.gz', 'offset': len(data), 'length': len(packed)})}")
        data += packed
    z.writestr("readme ä.txt", "x" * 70)
    z.writestr("archive/d.warc.gz", data, method)
    z.writestr("indexes/i.cdxj", "\n".join(lines), index_method)
    for i in range(count):
        z.writestr(f"extra/{i}", "")
    z.comment = comment


def paths_of(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_directories_of_other_writers(spark, tmp_path):
    """Plain, ZIP64 sizes and counts, many entries, something before the package."""
    bodies = [b"one", b"", b"three" * 50_000]
    plain = package_dir(tmp_path, "a.wacz", lambda z: standard(z, bodies))
    wide = package_dir(tmp_path, "b.wacz", lambda z: standard(z, bodies), ZIP64_LIMIT=50)
    many = package_dir(tmp_path, "c.wacz", lambda z: standard(z, bodies, count=70_000))
    shifted = str(tmp_path / "d.wacz")
    with open(shifted, "wb") as out, open(wide, "rb") as f:
        out.write(b"#!/bin/sh\n" * 9 + f.read())
    assert b"PK\x06\x06" in open(wide, "rb").read() and b"PK\x06\x06" in open(many, "rb").read()
    odd = package_dir(tmp_path, "o.wacz", lambda z: standard(z, bodies, comment=b"PK\x05\x06 signature in a comment"))
    for path in (plain, wide, many, shifted, odd):
        got = warc_zip.read_records(paths_of(spark, path), run_bytes=100).collect()
        assert sorted(r["payload"] for r in got) == sorted(map(bytearray, bodies))
        if path == odd:                                # the standard reader stops at this comment
            continue
        listed = {r["name"]: r for r in warc_zip.package_members(paths_of(spark, path)).collect()}
        with zipfile.ZipFile(path) as z:
            assert {i.filename: (i.compress_type, i.compress_size, i.file_size) for i in z.infolist()} == {
                n: (r["method"], r["packed"], r["size"]) for n, r in listed.items()}
            with open(path, "rb") as f:
                f.seek(listed["archive/d.warc.gz"]["start"])
                assert f.read(listed["archive/d.warc.gz"]["size"]) == z.read("archive/d.warc.gz")


def test_packages_that_cannot_be_read(spark, tmp_path):
    deflated = package_dir(tmp_path, "a.wacz", lambda z: standard(z, [b"x" * 99], zipfile.ZIP_DEFLATED))
    good = package_dir(tmp_path, "b.wacz", lambda z: standard(z, [b"x" * 99]))
    data = open(good, "rb").read()
    torn, empty, broken = (str(tmp_path / n) for n in ("t.wacz", "e.wacz", "x.wacz"))
    open(torn, "wb").write(data[:-40])
    open(empty, "wb").write(b"")
    at = data.index(b"\x1f\x8b") + 30
    open(broken, "wb").write(data[:at] + bytes([data[at] ^ 255]) + data[at + 1:])
    for path, what in ((deflated, "not stored"), (torn, "end of central directory"), (empty, "not a ZIP"),
                       (broken, "record at")):
        with pytest.raises(Exception, match=what):
            warc_zip.read_records(paths_of(spark, path)).collect()
    assert warc_zip.read_records(paths_of(spark, good).limit(0)).count() == 0


def test_pages_through_packages(spark):
    """Nulls, empty, repeated, long and odd rows; many small packages."""
    big = "é" * 600
    rows = [(1, "http://a.b/c d\r\nX: y", big, "x", 1, "p", "k"), (5, None, big, None, None, None, None),
            (5, None, big, None, None, None, None), (None, "u", big, "x", 1, "p", "k"), (7, "", None, "", 0, "", ""),
            (8, "http://[::1/", "", "", 0, "", ""), (9, "h", "short", "", 0, "", ""), (10, "h", "short", "", 0, "", ""),
            (11, "h", "long " * 500_000, "", 0, "", ""), (12, "h", "y" * 999, "", 0, "", ""), (13, "h", "y" * 999, "", 0, "", "")]
    df = spark.createDataFrame(rows * 1, PAGE)
    packages = warc_zip.write_packages(warc_zip.mark_revisits(df, "page_id", "url", F.col("html")), max_bytes=200)
    assert packages.agg(F.sum("records")).first()[0] == len(rows) and packages.count() >= 3
    records = warc_zip.read_records(packages)
    got = Counter((r["key"] and int(r["key"]), r["payload_bytes"], r["payload_digest"], r["type"],
                   r["refers_to"] and int(r["refers_to"])) for r in warc_zip.resolve_revisits(records).collect())

    def body(x):
        return (x or "").encode()
    want = Counter()
    first = [5]                                        # one of the two equal rows is the response
    for key, _, html, *_ in rows:
        revisit = html == big and not (key in first and not first.remove(key))
        want[(key, len(body(html)), hashlib.sha1(body(html)).hexdigest(), "revisit" if revisit else "response",
              5 if revisit else None)] += 1
    assert got == want
    back = {r["key"]: r for r in records.collect()}
    assert back["1"]["uri"] == "http://a.b/c d%0D%0AX: y" and back["5"]["uri"] is None and back["1"]["payload"] is None
    assert bytes(back["11"]["payload"]).decode() == "long " * 500_000
    none = warc_zip.write_packages(warc_zip.mark_revisits(df.limit(0), "page_id", "url", F.col("html")))
    assert none.count() == 0 and warc_zip.resolve_revisits(warc_zip.read_records(none)).count() == 0


# ---- 12 --------------------------------------------------------------------------------
def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, [float(c) for c in v], "w") for i, v in enumerate(base)]
    rows += [(900 + i, rows[0][1], "w") for i in range(150)]           # a third are copies
    rows += [(1, None, "w"), (2, [1.0, None, 0.0, 0.0, 0.0, 0.0], "w"), (3, [float("nan")] * 6, "w"),
             (4, [float("inf")] * 6, "w"), (None, rows[7][1], None), (5, [], "w"), (6, [1.0, 2.0], "w")]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, whitened string")
    x = df.filter(whitening.usable("v")).select("vec_id", "whitened", whitening.grid("v", 64, 1_000_000).alias("x"))
    w = whitening.fit(x, 4, rows_per_block=32)
    fit = np.unique(np.floor(64 * base).astype(np.int64) + 1_000_000, axis=0)
    n, s = len(fit), fit.sum(0)
    assert (w.n, w.sums) == (n, s.tolist())
    centred = (n * fit - s) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    assert np.allclose(w.variances, e[::-1][:4], rtol=1e-12) and np.allclose(w.explained, e[::-1][:4] / e.sum())
    assert w.identity_error < 1e-9
    got = whitening.project(x, w).collect()
    assert len(got) == 300 + 150 + 1
    for r in got:
        d = n * np.array(r["x"]) - s
        assert r["deviation"] == int((d.astype(object) ** 2).sum())
        want = (d / n) @ w.components / np.sqrt(w.variances)
        assert np.allclose(r["whitened"], want, rtol=1e-9, atol=1e-9)
    for k in range(4):                                                 # unit eigenvectors, either sign
        assert abs(abs(w.components[:, k] @ u[:, -1 - k]) - 1) < 1e-9


def test_whitening_without_variance(spark):
    df = spark.createDataFrame([(1, [3, 4]), (2, [3, 4]), (3, None)], "vec_id long, x array<bigint>")
    for rows, n in ((df, 1), (df.limit(0), 0), (df.filter("x is null"), 0)):
        w = whitening.fit(rows, 16)
        assert w.n == n and whitening.project(rows, w).count() == 0
    flat = spark.createDataFrame([(i, [i, 7, 2 * i]) for i in range(9)], "vec_id long, x array<bigint>")
    w = whitening.fit(flat, 16)                                        # one direction only
    assert len(w.variances) == 1 and w.identity_error < 1e-9
    with pytest.raises(ValueError, match="entries"):
        whitening.fit(spark.range(2).select(F.sequence(F.lit(1), F.lit(3000)).cast("array<bigint>").alias("x")), 2)
