"""Exact distinct counts from stored partials (O-44, O-45): mergeable sets instead of a scan of the events.

Distinct pools and transactions cannot be added up over hours. Here each value has a number from a
dictionary, and a partial row holds the set of the numbers that a (protocol, event type, hour)
has, as bitmaps of 32,768 numbers each. Sets of any hours are merged by ``or`` and counted, so statistics
over any range are exact and no value is shuffled. Numbers are given in the order of first
appearance, so the transactions of an hour lie close together: an hour has about as many
bitmaps as it has transactions / 32,768.

Tables under one folder: ``dictionary/column=C/version=V`` (value, code), ``counts/event_month=M`` and
``sets/event_month=M``. Months are rebuilt one by one (dynamic partition overwrite); numbers are never changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import scratch_path
from . import files

COLUMNS = {"pool": "pool_address", "tx": "transaction_hash"}
GROUP = ["protocol", "event_type"]


def dictionary(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """``value, code`` of a column, or None where nothing has been numbered yet."""
    folder = f"{path}/dictionary/column={column}"
    versions = files.values(spark, folder, "version")
    if not versions:
        return None
    return spark.read.schema("value string, code long").parquet(*[f"{folder}/version={v}" for v in versions])


def extend_dictionary(events: DataFrame, path: str, column: str) -> None:
    """Number the values of ``column`` that have no number yet, in the order of their first appearance, from 1 without gaps.

    Each task numbers its own range of the sorted values; the driver adds up how many the tasks before it have
    (one number per task). Run again after it was cut off, it writes the same version again.
    """
    spark = events.sparkSession
    known = dictionary(spark, path, column)
    values = events.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.min("timestamp").alias("seen"))
    if known is not None:
        values = values.join(known, "value", "left_anti")
    sorted_ = values.repartitionByRange("seen", "value").sortWithinPartitions("seen", "value")
    part = scratch_path(spark, "dexflow-codes")
    order = F.monotonically_increasing_id()
    sorted_.select("value", F.shiftright(order, 33).alias("task"), order.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")).write.parquet(part)
    part = spark.read.schema("value string, task long, at long").parquet(part)
    sizes = part.groupBy("task").count().orderBy("task").collect()  # a row for each task
    if not sizes:
        return
    last = 0 if known is None else known.agg(F.max("code")).first()[0]
    starts = []
    for s in sizes:
        starts.append((s["task"], last + 1))
        last += s["count"]
    starts = spark.createDataFrame(starts, "task long, start long")
    version = len(files.values(spark, f"{path}/dictionary/column={column}", "version"))
    (part.join(F.broadcast(starts), "task").select("value", (F.col("start") + F.col("at")).alias("code"))
         .write.mode("overwrite").parquet(f"{path}/dictionary/column={column}/version={version}"))


def bitmaps(codes: DataFrame) -> DataFrame:
    """The sets of the distinct ``codes`` of each group and hour.

    Codes are dealt by bitmap before the aggregate: every bitmap (4 KB) is built once, in one task, and none is shuffled.
    """
    keys = [*GROUP, "hour", "bucket"]
    bits = codes.select(*keys[:-1], F.bitmap_bucket_number("code").alias("bucket"), F.bitmap_bit_position("code").alias("position"))
    return bits.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("position").alias("bits"))


def write_partials(events: DataFrame, path: str) -> None:
    """Write (or replace) the partials of the months that ``events`` (rows of the event table, whole months) has.

    Pairs of group and value are made distinct before they meet the dictionary, so a hot pool is one row per task
    and hour there.
    """
    spark, path = events.sparkSession, path.rstrip("/")
    hourly = events.withColumn("hour", X.hour_start("timestamp"))
    month = (F.year("hour") * 100 + F.month("hour")).cast("int").alias("event_month")
    counts = hourly.groupBy(*GROUP, "hour").agg(F.count(F.lit(1)).alias("event_count"), F.min("timestamp").alias("first_ms"),
                                                F.max("timestamp").alias("last_ms"))
    write = lambda df, name: (df.select("*", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                              .partitionBy("event_month").option("compression", "zstd").parquet(f"{path}/{name}"))
    write(counts, "counts")
    sets = None
    for kind, column in COLUMNS.items():
        extend_dictionary(events, path, column)
        pairs = hourly.select(*GROUP, "hour", F.col(column).alias("value")).distinct()
        codes = dictionary(spark, path, column)
        if codes is None:
            continue
        mine = bitmaps(pairs.join(codes, "value")).select(*GROUP, "hour", F.lit(kind).alias("kind"), "bucket", "bits")
        sets = mine if sets is None else sets.unionByName(mine)
    if sets is not None:
        write(sets, "sets")


def _in_hours(df: DataFrame, start_ms: int | None, end_ms: int | None) -> DataFrame:
    for ms, keep in ((start_ms, lambda t: F.col("hour") >= t), (end_ms, lambda t: F.col("hour") < t)):
        if ms is not None:
            t = X.seconds_time(F.lit(int(ms)))
            month = (F.year(t) * 100 + F.month(t)).cast("int")
            df = df.filter(keep(t)).filter(F.col("event_month") >= month if ms is start_ms else F.col("event_month") <= month)
    return df


def _merged(spark: SparkSession, path: str, group: list[str], start_ms: int | None, end_ms: int | None) -> DataFrame:
    path = path.rstrip("/")
    base = _in_hours(spark.read.parquet(f"{path}/counts"), start_ms, end_ms).groupBy(*group).agg(
        F.sum("event_count").alias("event_count"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))
    sets = _in_hours(spark.read.parquet(f"{path}/sets"), start_ms, end_ms)
    sizes = sets.groupBy(*group, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    sizes = sizes.groupBy(*group).agg(of("pool").alias("unique_pools"), of("tx").alias("unique_transactions"))
    return base.join(sizes, group, "left").fillna(0, ["unique_pools", "unique_transactions"])


def event_stats(spark: SparkSession, path: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """O-44 from the partials, exact, over the whole hours that begin in [start_ms, end_ms)."""
    return _merged(spark, path, GROUP, start_ms, end_ms).select(
        *GROUP, "event_count", "unique_pools", "unique_transactions",
        X.seconds_time("first_ms").alias("first_event"), X.seconds_time("last_ms").alias("last_event"))


def hourly_rollup(spark: SparkSession, path: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """O-45 from the partials, exact."""
    return _merged(spark, path, [*GROUP, "hour"], start_ms, end_ms).select(*GROUP, "hour", "event_count", "unique_pools", "unique_transactions")
