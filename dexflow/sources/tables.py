"""Readers for the input tables and for decoded contract logs (O-01, O-02)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; parquet, so filters and projections reach the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_decoded_logs(spark: SparkSession, path: str, fmt: str = "parquet", emitter: bool = False) -> DataFrame:
    """Batch source of already decoded logs with the declared schema (no inference), with their ``emitter`` if the source has it."""
    return spark.read.schema(schemas.DECODED_LOGS_WITH_EMITTER if emitter else schemas.DECODED_LOGS).format(fmt).load(path)


def stream_decoded_logs(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None, emitter: bool = False) -> DataFrame:
    """Streaming twin of :func:`read_decoded_logs` over the same schema.

    A Kafka source is the same transform chain with ``format("kafka")`` and a
    ``from_json`` step; the rate limit maps to ``maxOffsetsPerTrigger``.
    """
    reader = spark.readStream.schema(schemas.DECODED_LOGS_WITH_EMITTER if emitter else schemas.DECODED_LOGS).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def decoded_logs_from_json(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decoded logs delivered as JSON messages (e.g. a Kafka topic's ``value``).

    ``spark.readStream.format("kafka")...load()`` followed by this function is
    the Kafka form of :func:`stream_decoded_logs`. Integer fields are read as
    text first, so quoted and unquoted numbers both parse; wide integers stay text.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.DECODED_LOGS.fields])
    parsed = raw.select(F.from_json(F.col(value_col).cast("string"), as_text).alias("m")).select("m.*")
    return parsed.select([(F.col(f.name) if isinstance(f.dataType, T.StringType)
                           else F.col(f.name).try_cast(f.dataType)).alias(f.name)
                          for f in schemas.DECODED_LOGS.fields])


def pool_logs(logs: DataFrame) -> DataFrame:
    """O-01: the pool-event part of a decoded-log feed (swap/mint/burn/sync/initialize)."""
    return logs.filter(F.col("event_name").isin("Swap", "Mint", "Burn", "Sync", "Initialize", "Collect", "Flash"))


def factory_logs(logs: DataFrame) -> DataFrame:
    """O-02: the pool-creation part of a decoded-log feed."""
    return logs.filter(F.col("event_name").isin("PairCreated", "PoolCreated"))
