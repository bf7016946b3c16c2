"""Verdicts over copies find changed values, pairs that cancel and missing rows, and say where."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow import schemas
from dexflow.operators import checks, reports
from dexflow.plans import catalog, sizing
from dexflow.sources import store


def table(spark, rows):
    base = {f.name: None for f in schemas.PROTOCOL_EVENTS.fields}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schemas.PROTOCOL_EVENTS)


def ev(i, month=202401, data="{}"):
    return {"id": i, "event_month": month, "event_data": data, "protocol": "uniswap-v2", "timestamp": 5}


def test_ids_that_cancel_in_pairs_are_found(spark):
    copies = {"a": table(spark, [ev("a"), ev("a"), ev("b")]), "b": table(spark, [ev("b"), ev("c"), ev("c")])}
    verdict = checks.copy_verdict(copies).first()
    assert verdict["consistent"] and not verdict["same_ids"]
    found = checks.differing_ids(copies["b"], copies["a"], checks.copy_differences(copies, "a"))
    assert {(r["id"], r["rows"], r["base_rows"]) for r in found.collect()} == {("a", 0, 2), ("c", 2, 0)}


def test_changed_null_and_missing_months_are_located(spark):
    base = table(spark, [ev(f"i{k}", 202401 + k % 3) for k in range(60)])
    changed = base.withColumn("event_data", F.when(F.col("id") == "i7", "{1}").otherwise(F.col("event_data")))
    moved = base.withColumns({"fee": F.when(F.col("id") == "i8", "x"), "gas_used": F.when(F.col("id") == "i9", "x")})
    shifted = moved.withColumns({"fee": F.col("gas_used"), "gas_used": F.col("fee")})
    copies = {"base": base, "same": base, "changed": changed, "short": base.filter("event_month <> 202402"), "empty": base.limit(0)}
    places = {(r["copy"], r["event_month"]) for r in checks.copy_differences(copies, "base").collect()}
    assert places == {("changed", 202402), ("short", 202402)} | {("empty", 202401 + k) for k in range(3)}
    found = checks.differing_ids(changed, base, checks.copy_differences({"base": base, "changed": changed}, "base"))
    assert [r["id"] for r in found.collect()] == ["i7"]
    # A value in another column, next to nulls, is a difference.
    found = checks.differing_ids(shifted, moved, checks.copy_differences({"m": moved, "s": shifted}, "m"))
    assert {r["id"] for r in found.collect()} == {"i8", "i9"}
    assert checks.copy_differences({"base": base, "same": base}, "base").count() == 0


def test_counts_while_writing(spark, tmp_path):
    ctx = catalog.Context(spark, SF_SMALL)
    seen = store.write_events_observed(ctx.events, str(tmp_path / "t"))
    want = checks.integrity_summary(store.read_events(spark, str(tmp_path / "t"))).first()
    assert all(seen[k] == want[k] for k in seen)


def test_dimension_is_counted_by_its_write(spark):
    """One job for the dimension: the count comes from the write."""
    sc = spark.sparkContext
    sc.setJobGroup("dimension", "dimension")
    try:
        small = sizing.materialize_dimension(spark.range(1000).repartition(4), 10_000)
        large = sizing.materialize_dimension(spark.range(1000), 10)
        jobs = sc.statusTracker().getJobIdsForGroup("dimension")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()
    # The shuffle of the first write is a job of its own under adaptive execution.
    assert len(jobs) <= 3


def test_sql_registers_no_view(spark):
    ctx = catalog.Context(spark, SF_SMALL)
    got = reports.sql_over_events(ctx.events, "SELECT count(*) AS n, '{x}' AS braces FROM protocol_events").first()
    assert got["n"] == ctx.events.count() and got["braces"] == "{x}"
    assert not any(t.name == "protocol_events" for t in spark.catalog.listTables())
