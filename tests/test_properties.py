"""Whole-table properties of the batch path at sf0.01."""

from pyspark.sql import functions as F

from conftest import SF_MID
from dexflow.operators import normalize as N, reports
from dexflow.plans import catalog


def test_accepted_plus_rejected_is_input(spark):
    ctx = catalog.context(spark, SF_MID)
    logs = N.with_log_metadata(ctx.logs)
    assert N.route_supported(logs).count() + N.route_rejected(logs).count() == ctx.logs.count()


def test_v3_swaps_have_exactly_one_side_per_token(spark):
    ctx = catalog.context(spark, SF_MID)
    swaps = ctx.normalized.filter((F.col("event_type") == "swap") & (F.col("version") == "v3"))
    bad = swaps.filter(((F.col("data_amount0In") != "0") == (F.col("data_amount0Out") != "0"))
                       | ((F.col("data_amount1In") != "0") == (F.col("data_amount1Out") != "0")))
    assert swaps.count() > 0 and bad.count() == 0


def test_ids_unique(spark):
    ev = catalog.context(spark, SF_MID).events
    assert ev.count() == ev.select("id").distinct().count()


def test_hourly_counts_sum_to_total(spark):
    ev = catalog.context(spark, SF_MID).events
    total = reports.hourly_rollup(ev).agg(F.sum("event_count")).first()[0]
    assert total == ev.count()


def test_stored_amount_text_never_cast(spark):
    """Values wider than DECIMAL(38,0) survive unchanged (no numeric cast anywhere)."""
    ctx = catalog.context(spark, SF_MID)
    wide = ctx.logs.filter(F.length("sqrt_price_x96") > 38).count()
    kept = ctx.normalized.filter(F.length("data_sqrtPriceX96") > 38).count()
    assert wide > 0 and kept == wide


def test_approx_stats_close_to_exact(spark):
    ev = catalog.context(spark, SF_MID).events
    exact = {(r.protocol, r.event_type): r for r in reports.event_stats(ev).collect()}
    approx = {(r.protocol, r.event_type): r for r in reports.event_stats(ev, approx=True).collect()}
    for k, r in exact.items():
        assert r.event_count == approx[k].event_count
        assert abs(r.unique_transactions - approx[k].unique_transactions) <= 0.1 * r.unique_transactions


def test_copy_verdict_checksum(spark):
    from dexflow.operators import checks
    ev = catalog.context(spark, SF_MID).events.select("id", "protocol", "timestamp")
    same = checks.copy_verdict({"a": ev, "b": ev}).first()
    assert same.consistent and same.same_ids and same.total_rows == 2 * ev.count()
    one_id = ev.select("id").first().id
    changed = ev.withColumn("id", F.when(F.col("id") == one_id, F.lit("other")).otherwise(F.col("id")))
    diff = checks.copy_verdict({"a": ev, "b": changed}).first()
    assert diff.consistent and not diff.same_ids          # same counts, different ids
    short = checks.copy_verdict({"a": ev, "b": ev.filter(F.col("id") != one_id)}).first()
    assert not short.consistent and not short.same_ids
