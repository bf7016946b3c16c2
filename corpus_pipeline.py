"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding, each on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of
``documents``; the last returns the shard and slot of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dexflow.llm import decontam, langid, minhash, mixing, shards
from dexflow.llm.common import saved
from dexflow.llm.queries import table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; those with no letter, or where no language reaches 0.3, go."""
    return langid.keep_identified(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group with a similarity of 0.8 or more on five-word shingles."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as many times as its rate says: toxic ones go, the others stay near the target shares."""
    return mixing.remix(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near-equal bytes."""
    return shards.shard_documents(docs, 8)


STAGES = [("language_id", identify), ("near_dedup", dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: SQL cannot express the trained stages; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
