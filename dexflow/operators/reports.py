"""Reports over the event table (O-30, O-43..O-47, O-53..O-57).

Each report returns a DataFrame and never collects. Ordering is applied only
where it is part of the answer (top-N, feeds); grouped reports keep an
optional cosmetic sort.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


def sql_over_events(events: DataFrame, query: str, view: str = "protocol_events") -> DataFrame:
    """O-05: run SQL text over the event table, which the text names ``view``.

    The table is passed as a parameter of the text, so nothing is registered in the session and queries that run at the
    same time do not replace each other's.
    """
    return events.sparkSession.sql(re.sub(rf"\b{re.escape(view)}\b", "{__events}", query.replace("{", "{{").replace("}", "}}")), __events=events)


def _distinct(col: str, approx: bool):
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


def newest_first():
    """Newest event first; ``id`` breaks timestamp ties so the answer is stable."""
    return [F.col("timestamp").desc(), F.col("id").desc()]


def event_count(events: DataFrame) -> DataFrame:
    """O-43 ``SELECT count() AS count``."""
    return events.agg(F.count(F.lit(1)).alias("count"))


def event_stats(events: DataFrame, approx: bool = False, ordered: bool = False) -> DataFrame:
    """O-44: per (protocol, event_type) count, distinct pools and transactions, first/last time."""
    out = events.groupBy("protocol", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        _distinct("pool_address", approx).alias("unique_pools"),
        _distinct("transaction_hash", approx).alias("unique_transactions"),
        X.seconds_time(F.min("timestamp")).alias("first_event"),
        X.seconds_time(F.max("timestamp")).alias("last_event"),
    )
    return out.orderBy(F.col("event_count").desc(), "protocol", "event_type") if ordered else out


def hourly_rollup(events: DataFrame, approx: bool = False) -> DataFrame:
    """O-45: per (protocol, event_type, hour) count and distinct pools / transactions."""
    return (events.withColumn("hour", X.hour_start("timestamp"))
                  .groupBy("protocol", "event_type", "hour")
                  .agg(F.count(F.lit(1)).alias("event_count"),
                       _distinct("pool_address", approx).alias("unique_pools"),
                       _distinct("transaction_hash", approx).alias("unique_transactions")))


def count_by_protocol(events: DataFrame) -> DataFrame:
    """O-46 ``SELECT protocol, count() AS event_count GROUP BY protocol``."""
    return events.groupBy("protocol").agg(F.count(F.lit(1)).alias("event_count"))


def top_groups(events: DataFrame, n: int = 10, approx: bool = False) -> DataFrame:
    """O-47: the ``n`` largest (protocol, event_type) groups with distinct pools (the timing probe)."""
    grouped = events.groupBy("protocol", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"), _distinct("pool_address", approx).alias("unique_pools"))
    return grouped.orderBy(F.col("event_count").desc(), "protocol", "event_type").limit(n)


def events_by_protocol(events: DataFrame, protocol: str, limit: int = 100) -> DataFrame:
    """O-30: newest ``limit`` events of one protocol (filter pushed to the scan; top-k per task)."""
    return events.filter(F.col("protocol") == F.lit(protocol)).orderBy(*newest_first()).limit(limit)


RECENT_COLUMNS = ["protocol", "event_type", "pool_address", "token0_symbol", "token1_symbol", "block_number"]


def recent_events(events: DataFrame, n: int = 10) -> DataFrame:
    """O-53: the ``n`` newest events, viewer projection with the event time in seconds."""
    top = events.orderBy(*newest_first()).limit(n)
    return top.select(*RECENT_COLUMNS, X.seconds_time("timestamp").alias("event_time"))


def recent_hours(events: DataFrame, n: int = 5, approx: bool = False) -> DataFrame:
    """O-54: the ``n`` newest rollup rows by hour (ties broken by group)."""
    return hourly_rollup(events, approx).orderBy(F.col("hour").desc(), "protocol", "event_type").limit(n)


FEED_COLUMNS = ["id", "protocol", "event_type", "block_number", "timestamp", "pool_address",
                "token0_symbol", "token1_symbol", "event_data"]


def feed_last(events: DataFrame, n: int = 20) -> DataFrame:
    """O-56: the live feed, the ``n`` newest events overall, with a rank (1 = newest)."""
    top = events.orderBy(*newest_first()).limit(n)
    # The window has no partition key on purpose: it only ever sees the n rows left by the limit.
    return top.select(*FEED_COLUMNS).withColumn(
        "feed_rank", F.row_number().over(Window.orderBy(*newest_first())).cast("bigint"))


def feed_panels(events: DataFrame, per_protocol: int = 5, feed_size: int = 20) -> DataFrame:
    """O-57: per-protocol panels: up to ``per_protocol`` newest **within** the feed.

    The feed limit comes first, so the window runs over ``feed_size`` rows only.
    """
    feed = events.orderBy(*newest_first()).limit(feed_size).select(*FEED_COLUMNS)
    w = Window.partitionBy("protocol").orderBy(*newest_first())
    return feed.withColumn("panel_rank", F.row_number().over(w).cast("bigint")).filter(F.col("panel_rank") <= per_protocol)
