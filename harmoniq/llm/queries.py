"""Bindings of the llm operators to the driver's tables: one query per
operator, over the whole intended table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmoniq.llm import (chosen_path, hosts, knn_quality, langmix, line_crf, log_bilinear, merkle, mixing, postings,
                          sharding, suffix_repeats, warc_zip, whitening)
from harmoniq.llm.common import is_held_out, read_table, record_batch
from harmoniq.llm.oracles import merkle_sql, warc_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SHARDS = 40


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


@query("op1_language_mixture")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    profiles = langmix.learn_profiles(docs.filter(~is_held_out("doc_id", 4)))
    return langmix.identify(docs, profiles, keep=["doc_id", is_held_out("doc_id", 4).alias("held_out")])


@query("op2_flow_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, F.array("source"))
    own = F.col("quotas")[0]
    return (mixed.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
            .select(F.col("id").alias("doc_id"), "size", own["size"].cast("bigint").alias("source_size"),
                    own["target"].alias("target"), "taken"))


@query("op3_host_reputation", hosts.ORACLE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return hosts.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@query("op5_positional_index")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = postings.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]

    def digest(batches):
        for b in batches:
            hit = [sum(s["to"] - s["from"] for s in spans) for spans in b.column("spans").to_pylist()]
            items = b.column("items").to_pylist()
            yield record_batch(names, [b.column("id"), b.column("n_words"), pa.array(hit, pa.int64()),
                                       pa.array([len(i) for i in items], pa.int64()), postings.digest_items(items),
                                       pa.array([h > 0 for h in hit], pa.bool_())])
    return found.mapInArrow(digest, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, "
                                    "items_sha256 string, contaminated boolean")


@query("op7_chosen_path_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_copies(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies")


@query("op10_rendezvous_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = sharding.assign_shards(docs.withColumn("law", F.lit("key")), [1.0] * SHARDS)
    return sharding.with_slots(placed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op4_knn_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = knn_quality.fit(docs.filter(~is_held_out("doc_id", 4)), labels=labels)
    return knn_quality.score(docs, model, keep=["doc_id", is_held_out("doc_id", 4).alias("held_out")])


@query("op6_line_crf")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_crf.judge(docs, line_crf.fit(docs), keep=["doc_id"])


@query("op8_log_bilinear")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return log_bilinear.score(docs, is_held_out("doc_id", 7)).withColumnRenamed("id", "doc_id")


@query("op9_suffix_repeats")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_merkle_manifest", merkle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    changed = [F.when(tampers, c + 1).otherwise(c) if i == 3 else c for i, c in enumerate(cols)]
    m = merkle.manifest(docs, "lang", "doc_id", merkle.leaf_digest(*cols),
                        ["doc_id", merkle.leaf_digest(*cols).alias("leaf"),
                         F.when(tampers, merkle.leaf_digest(*changed)).alias("tampered")])
    arity = m.tree.arity
    top = merkle.fold(merkle.fold(F.coalesce("tampered", "leaf"), F.col("pos"), F.col("path"), arity),
                      F.col("run_pos"), F.col("run_path"), arity)
    siblings = F.array_join(F.flatten(F.concat("path", "run_path")), "")
    return merkle.proofs(m).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        top.alias("folded_root"), (top == F.col("root")).alias("verified"))


@query("op12_block_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").filter(whitening.usable("embedding")).select(
        "vec_id", whitening.grid("embedding", 64, 1_000_000).alias("x"))
    w = whitening.fit(rows, 16)
    share = F.array(*[F.lit(float(e)) for e in w.explained]).cast("array<double>")
    return whitening.project(rows, w).select("vec_id", "deviation", F.posexplode("whitened")).select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(w.n).cast("bigint").alias("n"), "deviation",
        F.col("col").alias("whitened"), share[F.col("pos")].alias("explained"),
        F.lit(w.identity_error).cast("double").alias("identity_error"))


@query("op11_warc_packages", warc_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    packages = warc_zip.write_packages(warc_zip.mark_revisits(pages, "page_id", "url", F.col("html")))
    return warc_zip.resolve_revisits(warc_zip.read_records(packages)).select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").cast("bigint").alias("refers_to"))
