"""The newest events of a stored table come from the months that settle them; lookups read few rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow.operators import reports
from dexflow.plans import catalog, derived
from dexflow.sources import store


@pytest.fixture(scope="module")
def ctx(spark):
    return catalog.Context(spark, SF_SMALL)


def ids(df):
    return [r["id"] for r in df.select("id").collect()]


@pytest.mark.parametrize("n", [1, 10, 300, 10**6])
def test_newest_equals_a_full_sort(spark, ctx, n):
    path = derived.months_path(ctx)
    whole = store.read_events(spark, path)
    assert ids(store.newest_events(spark, path, n)) == ids(whole.orderBy(*reports.newest_first()).limit(n))
    mine = F.col("protocol") == "uniswap-v3"
    assert ids(store.newest_events(spark, path, n, mine)) == ids(whole.filter(mine).orderBy(*reports.newest_first()).limit(n))
    rare = F.col("event_type") == "initialize"
    assert ids(store.newest_events(spark, path, n, rare)) == ids(whole.filter(rare).orderBy(*reports.newest_first()).limit(n))


def test_one_month_of_many_is_read(spark, ctx):
    path = derived.months_path(ctx)
    months = sorted(r[0] for r in store.read_events(spark, path, ["event_month"]).distinct().collect())
    files = store.newest_events(spark, path, 10).inputFiles()
    assert len(months) > 3 and files and all(f"event_month={months[-1]}/" in f for f in files)


def test_newest_of_batches_and_of_nothing(spark, ctx, tmp_path):
    path = str(tmp_path / "b")
    events = store.read_events(spark, derived.months_path(ctx)).cache()
    for b in range(3):
        store.write_events(events.filter(F.col("block_number") % 3 == b), path, batch_id=b)
    assert ids(store.newest_events(spark, path, 15)) == ids(events.orderBy(*reports.newest_first()).limit(15))
    assert store.newest_events(spark, str(tmp_path / "none"), 5).count() == 0


def scanned_rows(df) -> int:
    """How many rows the file scan of an executed plan gave out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups(spark, ctx, tmp_path):
    """O-08: a lookup reads the row groups that may hold the value; without the filters it reads all.

    Hashes are random, so minima and maxima skip nothing. The dictionary of a small row group would, and takes the
    place of its filter; with as many values as a large one has there is none, which a small limit brings about here.
    """
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "parquet.dictionary.page.size": "64"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        read = {}
        for bloom in (True, False):
            path = str(tmp_path / f"bloom-{bloom}")
            store.write_events(ctx.events.withColumn("transaction_hash", F.sha2("transaction_hash", 256)), path, bloom=bloom, partitions=8)
            table = store.read_events(spark, path)
            hashes = [r[0] for r in table.select("transaction_hash").distinct().orderBy("transaction_hash").limit(400).collect()][100:400:60]
            read[bloom] = sum(scanned_rows(table.filter(F.col("transaction_hash") == h)) for h in hashes)
            total = table.count() * len(hashes)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert read[False] > 0.9 * total
    assert 0 < read[True] < total / 3
