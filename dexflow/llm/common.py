"""Helpers shared by the training-data operators: scratch tables and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dexflow-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to shared scratch and read it back.

    This cuts the lineage (a lost executor re-reads files, nothing is
    recomputed), gives later joins true sizes, and lets adaptive execution split
    hot keys: it only splits joins whose inputs come straight from a shuffle,
    not those that stand on an aggregate. The driver's garbage is collected
    afterwards so that Spark removes the shuffle files of the finished job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``a, b`` (longs): one row ``node, component`` per linked node.

    ``component`` is the smallest node reachable. Alternating large-star and
    small-star steps point every node at the smallest neighbour known so far,
    until nothing changes; the rounds grow with the logarithm of the
    longest path. A node with very many links is spread by the splitting of skewed
    joins, and every minimum is combined before its shuffle. Links with a null end
    and links of a node to itself are ignored; no links give no rows.
    """
    ab = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = saved(ab.where("a < b and a is not null and b is not null").distinct(), "links")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before or not state[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), "large-star")
        large = (both.where("v > u").join(least, "u").where("m < v")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())
        large = saved(large, "large-star-links")
        least = saved(large.groupBy("b").agg(F.min("a").alias("m")), "small-star")
        small = (large.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .unionByName(least.select(F.col("m").alias("a"), "b")).distinct())
        now = saved(small, "small-star-links")
