"""Corpus pipeline: raw documents to mixed, sharded training data in five stages.

Each stage takes what its predecessor kept and calls one operator.  `run` writes every stage to the shared folder
before the next one reads it, so a lost executor costs no more than part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, mixing, sharding, simhash, toxicity
from tidemark.llm.common import shared_folder

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier chain rejects go.  Without labels all stay."""
    labels = toxicity.label_categories(_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, toxicity.train(docs, labels, toxicity.CATEGORIES))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest doc_id stays."""
    return simhash.deduplicate(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an exact or edited copy of a test item go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; documents are repeated as often as the mix takes them."""
    return mixing.mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and the shard it would have with one more."""
    sized = docs.withColumns({
        "size": (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long"),
        "text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
    })
    return sharding.shard_records(sized, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# A trained model, hashes of shingles and alignments are beyond SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
