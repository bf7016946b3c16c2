"""A hot key (one pool with most of the events) is split, not sent to one task; aggregates combine map-side."""

from pyspark.sql import functions as F

from conftest import SF_MID
from dexflow.operators import enrich
from dexflow.plans import events as E
from dexflow.sources import fixtures
from helpers import plan_text

HOT = "0x" + "1".rjust(40, "0")


def skewed_logs(spark, copies=30):
    """Decoded logs where pool 1 gets ``copies`` extra copies of its events (distinct tx hashes)."""
    logs = fixtures.decoded_logs(spark, SF_MID)
    hot = (logs.filter((F.col("pool_address") == HOT) & ~F.col("event_name").isin("PairCreated", "PoolCreated"))
               .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
               .withColumn("transaction_hash", F.concat(F.col("transaction_hash"), F.lit("-c"), F.col("copy")))
               .drop("copy"))
    return logs.unionByName(hot)


def test_hot_pool_join_is_split_by_aqe(spark, fx_dims):
    logs = skewed_logs(spark)
    n = E.routed_logs(logs)
    share = n.filter(F.col("pool_address") == HOT).count() / n.count()
    assert share > 1 / 3
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dim = E.pool_dimension(n, fx_dims)
        joined = enrich.attach_pools(E.pool_events(n), dim, max_broadcast_rows=0)
        rows = joined.count()
        joined.collect()
        final = plan_text(joined)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in final and "skew=true" in final
    expected = enrich.attach_pools(E.pool_events(n), E.pool_dimension(n, fx_dims)).count()
    assert rows == expected


def test_first_creation_is_a_combining_aggregate(spark):
    n = E.routed_logs(skewed_logs(spark))
    text = plan_text(enrich.first_pools(E.factory_events(n)))
    assert text.count("HashAggregate") >= 2 or text.count("ObjectHashAggregate") >= 2 or "SortAggregate" in text
    assert "Window" not in text


def test_event_table_same_rows_with_shuffle_join(spark, fx_dims):
    """The one-pass build (factory rows passing through a left join) gives the same rows broadcast or not."""
    from dexflow import schemas
    logs = fixtures.decoded_logs(spark, SF_MID)
    cols = [c for c in schemas.EVENT_COLUMNS if c != "created_at"]
    small = E.build_event_table(logs, fx_dims).select(*cols)
    spark.conf.set("dexflow.maxBroadcastRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = E.build_event_table(logs, fx_dims).select(*cols)
        text = plan_text(big)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
        assert big.exceptAll(small).count() == 0 and small.exceptAll(big).count() == 0
    finally:
        spark.conf.unset("dexflow.maxBroadcastRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
