"""The written table: scans prune and push down, compaction holds across months, readers use it."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow.plans import catalog
from dexflow.sources import store
from helpers import plan_text

MONTH_MS = 31 * 24 * 3600 * 1000


def test_time_range_prunes_months_and_columns(spark):
    plan = plan_text(catalog.QUERIES["stored_time_range"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert "GreaterThanOrEqual(timestamp" in plan and "event_data" not in plan


def test_lookup_reaches_the_scan(spark):
    plan = plan_text(catalog.QUERIES["stored_lookup_tx"](spark, SF_SMALL))
    assert "EqualTo(transaction_hash" in plan and "Exchange" not in plan


def _two_months(spark, path):
    """Ten events stored in January and, delivered again, in February."""
    jan = catalog.context(spark, SF_SMALL).events.orderBy("id").limit(10)
    again = (jan.withColumn("timestamp", F.col("timestamp") + MONTH_MS)
                .withColumn("event_month", F.lit(202402)))
    store.write_events(jan, path, batch_id=0)
    store.write_events(again, path, batch_id=1)


def test_months_around():
    assert store.months_around(202401, 1) == [202312, 202401, 202402]
    assert store.months_around(202312, 1) == [202311, 202312, 202401]


def test_compaction_holds_across_months(spark, tmp_path):
    path, out = str(tmp_path / "live"), str(tmp_path / "compacted")
    _two_months(spark, path)
    for month in (202401, 202402):
        store.compact_month(spark, path, month, out)
    table = spark.read.parquet(out)
    assert table.count() == 10 and table.select("id").distinct().count() == 10
    assert {r.event_month for r in table.select("event_month").distinct().collect()} == {202401}


def test_reader_uses_compacted_months(spark, tmp_path):
    path, out = str(tmp_path / "live"), str(tmp_path / "compacted")
    _two_months(spark, path)
    store.compact_month(spark, path, 202401, out)
    read = store.read_compacted(spark, path, out, ["id", "event_month"])
    rows = read.collect()
    assert len(rows) == 10 == len({r.id for r in rows}) and {r.event_month for r in rows} == {202401}
    # An open month's own event stays.
    other = (catalog.context(spark, SF_SMALL).events.orderBy(F.desc("id")).limit(1)
             .withColumn("event_month", F.lit(202402)).withColumn("timestamp", F.col("timestamp") + MONTH_MS))
    store.write_events(other, path, batch_id=2)
    assert store.read_compacted(spark, path, out, ["id"]).count() == 11
