"""Operators of harmoniq.llm against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harmoniq.llm import (chosen_path, hosts, knn_quality, langmix, line_crf, log_bilinear, mixing, postings, sharding,
                          suffix_repeats)
from harmoniq.llm.queries import QUERIES
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, host string, shard int"


@pytest.fixture(scope="module")
def corpus(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def run(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_SMALL).collect()}


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing names."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, None, None, None, None, None, None, None), (None, "a b c", None, None, None, None, None, None),
            (2, "", "en", "s", 0, 0.5, "h", 3), (3, words * 20_000, "en", "s", 1, 0.5, "h", 3),
            (4, words, "fr", None, 2, None, None, None), (4, words, "fr", None, 2, None, None, None),
            (5, words, "fr", "t", 2, None, None, None), (6, "!!! 123", "en", "t", 2, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


# ---- 1 ---------------------------------------------------------------------------------
def test_languages_on_held_out_documents(spark, corpus):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = run(spark, "op1_language_mixture")
    assert set(got) == set(corpus)
    assert all(r["held_out"] == (crc(i, 4) == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) >= 0.95


def test_language_mixture_of_two_halves(spark):
    en, fr = "the cat and the dog with the bird " * 20, "le chat et la souris dans une maison " * 20
    train = spark.createDataFrame([(en, "en"), (fr, "fr"), (None, "en"), (en, None)], "text string, lang string")
    prof = langmix.learn_profiles(train)
    assert list(prof) == ["en", "fr"]
    d = spark.createDataFrame([(en + fr, 9.0), (None, 1.0), ("", 1.0), ("123 !", 1.0)], "text string, score double")
    got = [(r["lang_pred"], round(r["score"], 1), len(r["mixture"])) for r in langmix.identify(d, prof).collect()]
    assert got[0][1:] in ((0.5, 2), (0.6, 2)) and [g[0] for g in got[1:]] == ["und"] * 3
    assert [r["lang_pred"] for r in langmix.identify(d, {}).collect()] == ["und"] * 4
    assert langmix.identify(d.limit(0), prof).count() == 0


def test_texts_of_four_and_five_languages():
    rng = np.random.default_rng(3)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(40)] for _ in range(6)]

    def counts(*parts):                              # (language, number of words)
        text = " ".join(w for k, n in parts for w in rng.choice(words[k], n)).encode()
        return langmix.trigram_counts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    p = langmix.likelihoods({str(k): counts((k, 4000)) for k in range(6)})
    h = np.stack([counts(*[(k, 200) for k in range(4)]), counts(*[(k, 200) for k in range(5)]),
                  counts((0, 400), (1, 200), (2, 200), (3, 200)), counts((5, 300))])
    got = langmix.infer(h, p)
    assert [np.flatnonzero(r > 0).tolist() for r in got] == [[0, 1, 2, 3], [0, 1, 2, 3, 4], [0, 1, 2, 3], [5]]
    assert got.max(axis=1) == pytest.approx([0.25, 0.2, 0.4, 1], abs=0.03)


# ---- 2 ---------------------------------------------------------------------------------
def test_flow_meets_quotas_with_overlap():
    flow = mixing.min_cost_flow([100, 50, 30], [[0], [0, 1], [1]], [90, 120], 3)
    into = [sum(f.get(s, 0) for f in flow) for s in (0, 1)]
    assert into == pytest.approx([90, 120])
    # second and third copies only where first copies do not suffice: 180 first-copy words
    used = [sum(f.values()) for f in flow]
    assert sum(min(u, c) for u, c in zip(used, [100, 50, 30])) == pytest.approx(170)


def test_water_fill_caps_and_reshares():
    got = mixing.water_fill([10, 100, 100], [1, 2, 3], 210, 3)
    assert got[0] == 30 and sum(got) == pytest.approx(210) and got[2] == pytest.approx(1.5 * got[1])


def test_mix_query(spark, corpus):
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got, again = run(spark, "op2_flow_mixing"), run(spark, "op2_flow_mixing")
    assert got == again and set(got) == set(corpus)
    size, taken = Counter(), Counter()
    for i, r in got.items():
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", corpus[i] or ""))
        assert r["taken"] <= 3 * r["size"]
        size[source[i]] += r["size"]
        taken[source[i]] += r["taken"]
    order = sorted(size, key=lambda s: s.encode())
    target = dict(zip(order, mixing.water_fill([size[s] for s in order], [(1, 2, 3)[k % 3] for k in range(len(order))],
                                               sum(size.values()), 3)))
    longest = max(r["size"] for r in got.values())
    for i, r in got.items():
        assert r["source_size"] == size[source[i]] and r["target"] == pytest.approx(target[source[i]])
    assert all(abs(taken[s] - target[s]) <= longest for s in size)


def test_mix_odd_rows(spark, odd):
    mixed = mixing.mix(odd, F.array("source"))
    rows = mixed.collect()
    assert sum(r["rows"] for r in rows) == odd.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    out = mixing.apply_mix(odd, mixed)
    assert out.columns == odd.columns and out.filter("text is null or text = ''").count() == 0
    assert mixing.mix(odd.limit(0), F.array("source")).count() == 0


# ---- 3 ---------------------------------------------------------------------------------
def test_hosts_and_rules(spark):
    urls = [(1, "http://A.example.org/es/x?q"), (2, "https://b.com/fr/1#t"), (3, "no scheme"), (4, None),
            (5, "http://x.org"), (6, "http://example.org/en/12"), (7, "http://u.net/de/"), (8, "http://c.com/de/")]
    d = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in hosts.judge_urls(d).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("b.com", "/fr/1", "com/fr/", "allow")
    assert got[3][:3] == ("", "", None) and got[4][:3] == ("", "", None)
    assert got[5][:3] == ("x.org", "", None) and got[6][2:] == ("example.org/en/1", "block")
    assert got[8][3] == "block" and got[7][3] in ("allow", "block")
    assert hosts.judge_urls(d.limit(0)).count() == 0


def test_reputation_follows_labels(spark):
    rows = [("good.a.com", True)] * 30 + [("bad.b.com", False)] * 30 + [("new.b.com", None), ("one.a.com", False)]
    got = {r["host"]: r for r in hosts.host_reputation(spark.createDataFrame(rows, "host string, good boolean")).collect()}
    assert got["good.a.com"]["verdict"] == "allow" and got["bad.b.com"]["verdict"] == "block"
    assert got["new.b.com"]["verdict"] == "block"                 # takes after its domain
    assert got["one.a.com"]["mean"] > got["bad.b.com"]["mean"]    # one bad page is shrunk towards a good domain


# ---- 4 ---------------------------------------------------------------------------------
def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op4_knn_quality"](spark, sf).collect() if r["held_out"]}
    held = [i for i in got if i in label]
    assert all(0 <= got[i]["score"] <= 1 and got[i]["predicted"] == int(got[i]["score"] >= 0.7) for i in held)
    assert np.mean([got[i]["predicted"] == label[i] for i in held]) >= 0.9


def test_vote_is_exact_in_blocks():
    rng = np.random.default_rng(0)
    v, q = knn_quality.unit(rng.normal(size=(300, 8))), knn_quality.unit(rng.normal(size=(20, 8)))
    label = rng.integers(0, 2, 300)
    model = {"vectors": v, "label": label, "weight": np.array([1.0, 0.5]), "prior": 0.5}
    got = knn_quality.vote(q, model, k=9, block=64)
    for i in range(20):
        near = np.argsort(-(v @ q[i]))[:9]
        w = np.maximum(v[near] @ q[i], 0) ** 4 * model["weight"][label[near]]
        assert got[i] == pytest.approx((w * label[near]).sum() / w.sum())


# ---- 5 ---------------------------------------------------------------------------------
def tokens(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def test_decontamination_against_brute_force(spark, corpus):
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = tokens(r["text"])
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(r["item_id"]))
    lengths = {len(x) for x in windows}
    for i, r in run(spark, "op5_positional_index").items():
        w, hit, items = tokens(corpus[i]), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    items |= windows[tuple(w[k:k + n])]
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == \
            (len(w), len(hit), len(items), digest, bool(hit))


def test_proximity_blocks_and_odd_texts(spark, odd):
    bench = spark.createDataFrame([(1, "Alpha beta gamma delta"), (2, None), (3, "..."), (1, "Alpha beta gamma delta"),
                                   (4, "kappa iota")], "item_id long, text string")
    one = postings.find_contamination(odd, bench).collect()
    many = postings.find_contamination(odd, bench, block_words=1).collect()      # a pass per item
    key = lambda r: (r["id"] or 0, r["key"])                                     # noqa: E731
    assert [(key(r), r["n_words"], r["spans"], r["items"]) for r in sorted(one, key=key)] == \
        [(key(r), r["n_words"], r["spans"], r["items"]) for r in sorted(many, key=key)]
    found = {r["id"]: r for r in one}
    assert found[1]["n_words"] == 0 and found[2]["spans"] == [] and len(one) == odd.count()
    assert [tuple(s) for s in found[5]["spans"]] == [(0, 4)] and found[5]["items"] == ["1"]
    text = spark.createDataFrame([(1, "alpha x beta gamma y delta")], "doc_id long, text string")
    exact = postings.find_contamination(text, bench).first()
    near = postings.find_contamination(text, bench, slop=2).first()
    assert exact["spans"] == [] and near["items"] == ["1"]
    assert len(postings.find_contamination(odd, bench.limit(0)).collect()) == odd.count()


# ---- 6 ---------------------------------------------------------------------------------
def test_base_counts_against_brute_force(spark, corpus):
    for i, r in run(spark, "op6_line_crf").items():
        t = corpus[i] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n3, hit, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
        for k in range(len(w) - 2):
            if n3[(w[k], w[k + 1], w[k + 2])] > 1:
                hit |= {k, k + 1, k + 2}
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == \
            (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed)
        assert not (failed and r["kept"])


def test_viterbi_and_gradient_against_enumeration():
    from itertools import product
    rng = np.random.default_rng(1)
    emit, trans = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    value = lambda y: sum(emit[i, y[i]] for i in range(6)) + sum(trans[y[i], y[i + 1]] for i in range(5))
    paths = list(product((0, 1), repeat=6))
    assert tuple(line_crf.viterbi(emit, trans)) == max(paths, key=value)
    z, p, pair = line_crf.forward_backward(emit, trans)
    weight = np.exp([value(y) for y in paths])
    assert z == pytest.approx(math.log(weight.sum()))
    assert p[2, 1] == pytest.approx(sum(w for w, y in zip(weight, paths) if y[2]) / weight.sum())
    assert pair[0, 1] == pytest.approx(sum(w * sum(y[i:i + 2] == (0, 1) for i in range(5)) for w, y in zip(weight, paths))
                                       / weight.sum())


def test_copies_do_not_fill_the_training_sample(spark):
    texts = [f"Line {i} of a plain text with words.\n| {i} | # | menu |" for i in range(40)]
    once = spark.createDataFrame([(t,) for t in texts], "text string")
    many = once.unionByName(once.filter(F.xxhash64("text") == once.select(F.min(F.xxhash64("text"))).first()[0])
                            .withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("k"))
    a, b = line_crf.fit(once, max_runs=20), line_crf.fit(many, max_runs=20)
    assert np.array_equal(a["w"], b["w"]) and np.array_equal(a["trans"], b["trans"]) and a["w"].any()


# ---- 7 ---------------------------------------------------------------------------------
def brute_links(texts):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else None
    distinct = list({s for s in sets.values() if s})
    near = [[9 * len(a & b) >= 4 * (len(a) + len(b)) for b in distinct] for a in distinct]
    links = {s: sum(r) - 1 for s, r in zip(distinct, near)}
    root = list(range(len(distinct)))
    for _ in distinct:
        root = [min(root[j] for j in range(len(distinct)) if near[i][j]) for i in range(len(distinct))]
    return sets, links, dict(zip(distinct, root))


def near_corpus():
    rng = np.random.default_rng(3)
    texts, k = {}, 0
    for g in range(6):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for c in range(12):
            w = list(base)
            for at in rng.integers(0, 120, c % 4):
                w[at] = f"v{rng.integers(0, 99999)}"
            texts[k] = " ".join(w)
            k += 1
    return texts | {k: None, k + 1: "", k + 2: "a b", k + 3: "A  b"}


@pytest.mark.parametrize("limit", [256, 4])
def test_near_copies_against_brute_force(spark, limit):
    texts = near_corpus()
    sets, links, root = brute_links(texts)
    first = {}
    for i in sorted(texts):
        if sets[i]:
            first.setdefault(root[sets[i]], i)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = chosen_path.near_copies(d, bucket_limit=limit).collect()
    assert len(got) == len(texts)
    for r in got:
        s = sets[r["id"]]
        assert (r["class_id"], r["n_links"]) == ((first[root[s]], links[s]) if s else (r["id"], 0))


def test_keep_one(spark, odd):
    kept = chosen_path.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6]
    assert chosen_path.keep_one(odd.limit(0)).count() == 0


def test_runs_reach_the_recall():
    runs = chosen_path.runs_for(0.999, 0.8, 2)
    assert (1 - 0.8 ** 3) ** runs <= 0.001 < (1 - 0.8 ** 3) ** (runs - 1)


def test_items_without_an_id_hit(spark):
    passage = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "free of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), ("a", "other words " * 6)], "item_id string, text string")
    got = {r["id"]: r for r in postings.find_contamination(docs, bench).collect()}
    assert [tuple(x) for x in got[1]["spans"]] == [(1, 13)] and got[1]["items"] == [] and got[2]["spans"] == []
    assert [r["doc_id"] for r in postings.drop_contaminated(docs, bench).collect()] == [2]


# ---- 8 ---------------------------------------------------------------------------------
def test_language_model_base_score_and_gain(spark, corpus):
    count = Counter()
    for i, t in corpus.items():
        if crc(i, 7) != 2:
            count.update(t.encode().lower().split())
            count["END"] += 1
    n, v = sum(count.values()), len(count)
    gain = {True: 0.0, False: 0.0}
    for i, r in run(spark, "op8_log_bilinear").items():
        w = corpus[i].encode().lower().split() + ["END"]
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(count[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        gain[r["held_out"]] += r["score"] - r["base_score"]
    assert gain[True] > 0 and gain[False] > 0


def test_model_probabilities_are_normalised():
    pairs = np.zeros((512, 512))
    pairs[0, 1] = pairs[1, 0] = 500
    pairs[0, 0] = 20
    table = log_bilinear.log_table(log_bilinear.train(pairs))
    assert np.allclose((10 ** table).sum(axis=1), 1)
    assert table[0, 1] > table[0, 0] and table[1, 0] > math.log10(0.5)


def test_language_model_odd_rows(spark, odd):
    got = log_bilinear.score(odd, F.lit(False)).collect()
    assert len(got) == odd.count() and {r["n_tokens"] for r in got if r["id"] in (1, 2)} == {1}
    assert log_bilinear.score(odd.limit(0), F.lit(False)).count() == 0


def rare_word_docs():
    """Words outside the core: equal counts and class, other neighbours."""
    common = [f"c{k:03d}" for k in range(log_bilinear.TOP + 5)]
    texts = [" ".join(common[k:] + common[:k]) for k in range(0, len(common), 7)]
    texts += ["c001 rarexx c002", "c003 seldomxx c004"] * 20
    return texts, ["c001 rarexx", "c001 seldomxx", "rarexx c002", "seldomxx c002"]


def test_words_outside_the_core_learn(spark):
    train, held = rare_word_docs()
    rows = [(k, t, k >= len(train)) for k, t in enumerate(train + held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = {r["id"]: r["score"] for r in log_bilinear.score(docs, F.col("held")).collect()}
    a, b, c, d = (got[len(train) + k] for k in range(4))
    assert a > b + 0.1 and c > d + 0.1


def test_blocks_and_groups_of_blocks_do_not_change_the_scores(spark, monkeypatch):
    """Many small blocks, summed by groups, with few known words: as one block."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("doc_id % 2 = 0")
    held = F.col("doc_id") % 14 == 0
    def scores(**k):
        return {r["id"]: (r["score"], r["base_score"], r["n_known"]) for r in log_bilinear.score(docs, held, **k).collect()}
    one = scores()
    monkeypatch.setattr(log_bilinear, "GROUP", 3)
    monkeypatch.setattr(log_bilinear, "KNOWN", log_bilinear.TOP + 50)
    many = scores(block_bytes=20_000)
    assert one.keys() == many.keys()
    for i, x in one.items():
        assert x[1:] == pytest.approx(many[i][1:], rel=1e-9) and x[0] == pytest.approx(many[i][0], rel=2e-3)


def test_classes_and_contexts_are_normalised(spark):
    rng = np.random.default_rng(1)
    pairs = rng.integers(0, 5, (512, 512)).astype(float)
    par = log_bilinear.train(pairs, steps=5)
    core = {"hidden": (par["r"] @ par["m"]).astype("f4"), "q": par["q"].astype("f4"), "b": par["b"].astype("f4")}
    core |= log_bilinear.sides(par, pairs)
    core["before"] = core["out"]["basis"]
    counts = rng.poisson(0.05, (300, 1024))
    counts[:40] = 0
    counts[np.arange(40), 7 * np.arange(40)] = 1
    counts[:, 512:] = counts[:, :512]
    cls, c = np.arange(300) % 64, counts[:, :512].sum(axis=1)
    assert (c == 1).any()
    v = log_bilinear.own_vectors(counts, cls, core)
    size = np.bincount(cls, c + 1.0, 64) + 1
    singles = log_bilinear.single_vectors(core)
    code = counts[:, :512].argmax(axis=1) * 513                        # the same symbol before and after
    once = log_bilinear.seen_once(singles, cls[c == 1], code[c == 1])
    assert once.tobytes() == v[c == 1].tobytes()
    rows = [(int(k), int(n), int(s), bytearray(x.tobytes() if n > 1 else b"")) for k, n, s, x in zip(cls, c, code, v)]
    z = log_bilinear.normalisers(spark.createDataFrame(rows, "class int, c bigint, code int, vectors binary"), core, size, singles)
    u = (v["out"] * v["out_scale"][:, None]) @ core["before"].T - z[cls]
    p = np.exp(u) * ((c + 1) / size[cls])[:, None]
    total = np.exp(-z) / size[:, None]                   # the unseen word
    np.add.at(total, cls, p)
    assert np.allclose(total, 1, atol=1e-4)
    after = np.exp(log_bilinear.hidden_of(v, cls, core) @ core["q"].T + core["b"] - v["log_z"][:, None])
    assert np.allclose(after.sum(axis=1), 1, atol=1e-4)


# ---- 9 ---------------------------------------------------------------------------------
def brute_repeats(raw):
    seen = Counter(t[k:k + 200] for t in raw for k in range(len(t) - 199))
    out = []
    for t in raw:
        edge = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                edge[k] += 1
                edge[k + 200] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(t) else 0
        out.append((len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("limit", [4000, 1])
def test_repeats_against_brute_force(spark, corpus, limit):
    texts = list(corpus.values())[:120] + ["ab" * 300, "x" * 450, None, "", "é" * 130, "same " * 60, "same " * 60]
    passage = list(corpus.values())[0][:260]
    texts += [f"left {i} {passage} right {i * 7}" for i in range(8)]
    want = brute_repeats([(t or "").encode() for t in texts])
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in suffix_repeats.remove_repeats(d, group_limit=limit).collect()}
    assert got == dict(enumerate(want))


def test_two_stage_order_is_the_suffix_order():
    for text in (b"banana", b"mississippi$", b"aaaaab", b"abababa", b"zyx", b"x"):
        x = np.frombuffer(text, np.uint8)
        order = suffix_repeats.two_stage_sort(x, np.ones(len(x), bool), 16, suffix_repeats.words_at(x, 16))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


# ---- 10 --------------------------------------------------------------------------------
def test_shards(spark, corpus):
    got = run(spark, "op10_rendezvous_shards")
    slots = defaultdict(list)
    for i, r in got.items():
        b = (corpus[i] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(b) + 16, zlib.crc32(b), "key")
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))


def test_weighted_shards_and_growth(spark):
    d = spark.range(20_000).withColumnRenamed("id", "doc_id").withColumn("shard", F.lit("clash"))
    got = sharding.assign_shards(d, [1.0, 3.0, 0.0]).groupBy("shard").count().collect()
    n = {r["shard"]: r["count"] for r in got}
    assert set(n) == {0, 1} and n[1] / 20_000 == pytest.approx(0.75, abs=0.02)
    small = sharding.assign_shards(d, [1.0] * 4).select("doc_id", F.col("grown_shard").alias("g"))
    large = sharding.assign_shards(d, [1.0] * 5).select("doc_id", "shard")
    assert small.join(large, "doc_id").filter("g != shard").count() == 0


# ---- pipeline --------------------------------------------------------------------------
def test_pipeline_stages(spark, odd):
    import corpus_pipeline
    docs, columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), None
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        columns = columns or docs.columns
        assert out.columns[:len(columns)] == columns and (k == 4 or out.columns == columns)
        docs = corpus_pipeline.store(out, f"t-{name}")
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] > 0 and sizes[3] == sizes[4] > 0
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF_SMALL).collect()
        assert stage(spark, odd.limit(0), SF_SMALL).count() == 0


def test_pipeline_against_brute_force(spark, corpus):
    """Near copies and benchmark passages of the input are gone; the others stay."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sets, links, root = brute_links(corpus)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL).collect()}
    first = {}
    for i in sorted(corpus):
        first.setdefault(root[sets[i]] if sets[i] else ("none", i), i)
    assert kept == set(first.values())
    clean = {r["doc_id"] for r in corpus_pipeline.decontaminate(spark, docs, SF_SMALL).collect()}
    assert clean == {i for i, r in run(spark, "op5_positional_index").items() if not r["contaminated"]}


def test_odd_rows_of_map_operators(spark, odd):
    model = knn_quality.fit(spark.createDataFrame([("good text here", 1), ("#### $$$", 0), (None, 1), ("x", None)],
                                                  "text string, quality int"))
    for out, new in ((knn_quality.score(odd, model), "score"), (line_crf.judge(odd, line_crf.fit(odd)), "kept"),
                     (sharding.assign_shards(odd, [1.0, 1.0]), "shard")):
        assert out.count() == odd.count() and out.columns.count(new) == 1
    empty = knn_quality.fit(odd.limit(0).withColumn("quality", F.lit(1)))
    assert {r["score"] for r in knn_quality.score(odd, empty).collect()} == {0.5}
    none = line_crf.judge(odd.limit(0), line_crf.fit(odd.limit(0)))
    assert none.count() == 0


# ---- repairs of round 3 ------------------------------------------------------------------
def test_slots_of_repeated_rows_null_keys_and_nothing(spark):
    """A row that makes up a third of the table is counted, not sorted."""
    rows = [(1, 5, 9, "x")] * 400 + [(None, 5, 9, None)] * 7 + [(i, i % 3, 9, "y") for i in range(800)] + [(1, 5, 9, None)] * 3
    d = spark.createDataFrame(rows, "doc_id long, size long, text_crc32 long, slot string")
    placed = sharding.assign_shards(d, [1.0] * 4)
    out = sharding.with_slots(placed, ["doc_id", "text_crc32", "size"], buckets=8)
    got = defaultdict(list)
    for r in out.collect():
        got[r["shard"]].append(r["slot"])
    assert sum(map(len, got.values())) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in got.values())
    again = sharding.with_slots(placed, ["doc_id", "text_crc32", "size"], buckets=8)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert sharding.with_slots(placed.limit(0), ["doc_id"]).count() == 0


def test_second_hash_race(spark):
    """The winner of a shard race, computed a second time outside Spark."""
    import struct

    import xxhash

    def spark_xx(key, shard, seed):                  # Spark chains its 64-bit hash over the columns from seed 42
        h = xxhash.xxh64_intdigest(key.encode(), 42)
        for v in (shard, seed):
            h = xxhash.xxh64_intdigest(struct.pack("<i", v), h)
        return h
    ids = list(range(60)) + [-4, 10 ** 12]
    weights = [1.0, 2.5, 0.5]
    d = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(d, weights).collect()}
    for i in ids:
        race = [(-math.log(((spark_xx(str(i), k, 0) >> 11) + 0.5) * 2.0 ** -53) / w, k) for k, w in enumerate(weights)]
        assert got[i] == min(race)[1]


def test_registered_domains(spark):
    names = {"shop.com.mx": ("shop.com.mx", "com.mx"), "a.shop.com.mx": ("shop.com.mx", "com.mx"), "x.co.in": ("x.co.in", "co.in"),
             "y.gov.uk": ("y.gov.uk", "gov.uk"), "a.b.example.org": ("example.org", "org"), "co.uk": ("co.uk", "co.uk"),
             "com": ("com", "com"), "co": ("co", "co"), "www.co.com": ("co.com", "com"), "": ("", ""), "a.de": ("a.de", "de")}
    d = spark.createDataFrame([(n,) for n in names], "host string")
    got = {r["host"]: (r["d"], r["s"]) for r in d.select("host", hosts.domain_of(F.col("host")).alias("d"),
                                                         hosts.suffix_of(F.col("host")).alias("s")).collect()}
    assert got == names


def test_both_ends_of_long_texts_are_drawn(spark, monkeypatch):
    """Every line of a text longer than a run can be drawn."""
    head, foot = "\n".join(f"MENU | ITEM {i} | MORE" for i in range(30)), "\n".join(f"# {i} # {i} #" for i in range(30))
    body = "\n".join(f"The {i} plain sentence of this text ends here." for i in range(300))
    seen = []
    monkeypatch.setattr(line_crf, "train_chain", lambda texts: seen.append(texts) or {})
    d = spark.createDataFrame([(f"{head}\n\n{body}\n{foot}",), (None,), ("",)], "text string")
    line_crf.fit(d, run_lines=50)
    whole = line_crf.line_features(f"{head}\n\n{body}\n{foot}".encode().split(b"\n"))[0]
    assert sum(len(x) for x, _ in seen[0]) == len(whole) == 360
    assert sorted(map(bytes, np.concatenate([x for x, _ in seen[0]]).astype("f4"))) == sorted(map(bytes, whole.astype("f4")))
    line_crf.fit(d, run_lines=50, max_runs=3)
    assert 2 <= len(seen[1]) <= 3 and all(len(x) <= 50 for x, _ in seen[1])


def test_a_long_item_is_cut_into_blocks(spark):
    """No block of phrases holds more words than the bound, and cutting changes nothing."""
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "w3 w4"), (None, "w39 w0")], "item_id long, text string")
    blocks = list(postings.phrase_blocks(bench, "item_id", "text", 10, 14))
    assert len(blocks) > 5 and all(len({w for p in ph for w in p}) <= 14 for ph, _ in blocks)
    assert sum(len(ph) for ph, _ in blocks) == 31 + 2
    docs = spark.createDataFrame([(1, " ".join(words[5:30])), (2, "x w3 w4 " + " ".join(words[20:33])), (3, "w39 w0 y"), (3, "w39 w0 y")],
                                 "doc_id long, text string")
    key = lambda r: (r["id"], str(r["spans"]), r["items"])                       # noqa: E731
    one = sorted(map(key, postings.find_contamination(docs, bench).collect()))
    many = sorted(map(key, postings.find_contamination(docs, bench, block_words=14).collect()))
    assert one == many and len(one) == 4
