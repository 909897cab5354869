"""Corpus pipeline: language ID, near-copy removal, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it back as the
next stage's input.  All stages but the last return the columns of documents.

Cases: a stage given no rows returns none; null texts are rejected by the
language stage; extra columns travel along (the last stage replaces columns
named shard or grown_shard).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmoniq.llm import chosen_path, langmix, mixing, postings, sharding
from harmoniq.llm.common import is_held_out, read_table, store
from harmoniq.llm.queries import SHARDS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with an identified language (op 1); 'und' texts and texts without a
    language that makes up half of them go."""
    return langmix.keep_identified(docs, langmix.learn_profiles(docs.filter(~is_held_out("doc_id", 4))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy class (op 7)."""
    return chosen_path.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (op 5)."""
    return postings.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it (op 2)."""
    return mixing.apply_mix(docs, mixing.mix(docs, F.array("source")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rendezvous shards of the records (op 10)."""
    return sharding.assign_shards(docs, [1.0] * SHARDS)


STAGES = [("language_id", identify_language), ("near_copies", drop_near_copies), ("decontamination", decontaminate),
          ("mixing", mix_sources), ("sharding", shard)]
# language sets, sampled paths and seeded selection have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
