"""Physical-plan checks: broadcast for dimensions, pruned scans, partition pruning, top-k, no Python, no cartesian."""

from pyspark.sql import functions as F

from conftest import SF_MID
from dexflow.operators import reports
from dexflow.plans import catalog
from dexflow.sources import store
from helpers import plan_text

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"]


def test_flagship_plan(spark):
    text = plan_text(catalog.q_event_stats(spark, SF_MID))
    assert "BroadcastHashJoin" in text
    for bad in FORBIDDEN:
        assert bad not in text
    # column pruning reaches the scan: the unused event columns are not read
    scan_schema = [line for line in text.splitlines() if line.startswith("ReadSchema") and "event_id" in line]
    assert scan_schema and all("props" not in s and "value" not in s for s in scan_schema)


def test_every_registered_query_avoids_python_and_cartesian(spark):
    for name, fn in catalog.QUERIES.items():
        text = plan_text(fn(spark, SF_MID))
        for bad in FORBIDDEN:
            assert bad not in text, (name, bad)


def test_top_n_plans(spark):
    ev = catalog.context(spark, SF_MID).events
    assert "TakeOrderedAndProject" in plan_text(reports.recent_events(ev))
    panels = plan_text(reports.feed_panels(ev))
    # the feed limit comes before the per-protocol window
    assert "TakeOrderedAndProject" in panels and "Window" in panels


def test_time_range_read_prunes_partitions(spark, tmp_path):
    ev = catalog.context(spark, SF_MID).events
    path = str(tmp_path / "events")
    shifted = ev.withColumn("timestamp", F.col("timestamp") + F.lit(31 * 24 * 3600 * 1000)) \
                .withColumn("event_month", F.lit(202402)).withColumn("id", F.concat(F.lit("s-"), "id"))
    store.write_events(ev.unionByName(shifted), path, mode="overwrite")
    feb = store.read_events(spark, path, start_ms=1706745600000)  # 2024-02-01
    text = plan_text(feb)
    assert "PartitionFilters" in text and "event_month" in text.split("PartitionFilters")[1].splitlines()[0]
    assert feb.select("event_month").distinct().collect() == [(202402,)]
    assert feb.count() == ev.count()
