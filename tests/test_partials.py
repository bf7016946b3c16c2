"""Exact distinct counts from stored partials: any range, month by month, without Expand."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow.operators import reports
from dexflow.plans import catalog, derived
from dexflow.sources import partials, store
from helpers import plan_text


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def ctx(spark):
    return catalog.Context(spark, SF_SMALL)


def test_months_can_be_added_and_rebuilt(spark, ctx, tmp_path):
    events = store.read_events(spark, derived.months_path(ctx))
    months = sorted(r[0] for r in events.select("event_month").distinct().collect())
    assert len(months) > 3
    path = str(tmp_path / "p")
    for m in [*months, months[1], months[0]]:  # in order, then two of them again
        partials.write_partials(events.filter(F.col("event_month") == m), path)
    assert rows(partials.event_stats(spark, path)) == rows(reports.event_stats(events))
    assert rows(partials.hourly_rollup(spark, path)) == rows(reports.hourly_rollup(events))
    lo = events.agg(F.min("timestamp")).first()[0] // 3_600_000 * 3_600_000
    for a, b in ((lo + 86_400_000, lo + 40 * 86_400_000), (lo, lo + 3_600_000), (lo - 10, lo - 5)):
        inside = events.filter((F.col("timestamp") >= a) & (F.col("timestamp") < b)) if a != lo - 10 else events.limit(0)
        assert rows(partials.event_stats(spark, path, a, b)) == rows(reports.event_stats(inside))


def test_codes_are_dense_and_kept(spark, ctx, tmp_path):
    events = store.read_events(spark, derived.months_path(ctx))
    path, early = str(tmp_path / "d"), events.filter(F.col("timestamp") < 1_703_000_000_000)
    partials.extend_dictionary(early, path, "transaction_hash")
    first = {r["value"]: r["code"] for r in partials.dictionary(spark, path, "transaction_hash").collect()}
    partials.extend_dictionary(events, path, "transaction_hash")
    partials.extend_dictionary(events, path, "transaction_hash")  # nothing new
    codes = {r["value"]: r["code"] for r in partials.dictionary(spark, path, "transaction_hash").collect()}
    assert sorted(codes.values()) == list(range(1, events.select("transaction_hash").distinct().count() + 1))
    assert first and all(codes[v] == c for v, c in first.items())


def test_no_expand_and_pruned_months(spark, ctx):
    path = derived.partials_path(ctx)
    plan = plan_text(partials.event_stats(spark, path, *derived.PARTIAL_RANGE_MS))
    assert "Expand" not in plan and "event_month" in plan.split("PartitionFilters")[1]
    assert "Expand" in plan_text(reports.event_stats(store.read_events(spark, derived.months_path(ctx))))
