"""Staging keeps logs without block or chain; a stream that is cut off raises; a foreign protocol's log joins no pool."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow.plans import catalog
from dexflow.streaming import replay


def test_null_blocks_are_staged(spark, tmp_path):
    logs = catalog.context(spark, SF_SMALL).logs
    holes = logs.withColumn("block_number", F.when(F.col("log_index") % 3 == 0, F.lit(None)).otherwise(F.col("block_number")))
    replay.stage_in_time_order(holes, str(tmp_path / "source"))
    assert spark.read.parquet(str(tmp_path / "source")).count() == holes.count()


def test_timeout_raises(spark, tmp_path):
    ctx = catalog.context(spark, SF_SMALL)
    with pytest.raises(TimeoutError):
        replay.run_file_stream(spark, ctx.logs, ctx.dims, root=str(tmp_path / "run"), timeout_s=1)


def test_per_chain_union_keeps_logs_without_chain(spark):
    ctx = catalog.Context(spark, SF_SMALL)
    ctx.logs = ctx.logs.withColumn("chain_id", F.when(F.col("chain_id") == 1, F.lit(None)).otherwise(F.col("chain_id")))
    assert ctx.per_chain_events().count() == ctx.events.count()
