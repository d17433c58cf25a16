"""A training corpus from the documents table, in five stages.

Language identification, near duplicates, benchmark decontamination, mixing of
the sources, sharding. Every stage takes all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.llm import chosen_path, decontamination, language_id, mixing, sharding
from deposit_analytics.llm.common import committed, word_count
from deposit_analytics.sources import sinks


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is certain enough, which becomes their ``lang``."""
    return language_id.identified(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return chosen_path.without_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix of the sources takes them."""
    return mixing.mixed(docs, word_count(F.col("text")), ties=(F.col("text"),)).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, all columns, with their shard and their slot in it; columns of those names get a new one."""
    text = F.col("text")
    shards = sharding.assign(docs, sharding.text_key(text), sharding.text_size(text))
    added = {
        "size": F.col("size"),
        "text_crc32": F.crc32(F.coalesce("doc.text", F.lit(""))),
        "law": F.lit("bytes"),
        "shard": F.col("shard"),
        "slot": F.col("slot"),
        "grown_shard": F.lit(None).cast("int"),
    }
    own = [F.col("doc").getField(name).alias(f"doc_{name}" if name in added else name) for name in docs.columns]
    return shards.select(*own, *[column.alias(name) for name, column in added.items()])


STAGES = [
    ("language_id", identified),
    ("jaccard_join", distinct),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Trigram likelihoods, chosen paths and fingerprints have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    Only the last result stays in the shared folder: a stage's own tables go when it
    is committed, and its predecessor's result with them.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, folder = committed(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        if before:
            sinks.drop_folder(spark, before)
        before = folder
    return docs
