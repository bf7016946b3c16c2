"""Pool discovery, seed precedence, token fallbacks and the event -> pool join."""

from pyspark.sql import functions as F

from dexflow import schemas
from dexflow.operators import enrich
from dexflow.plans import events as E

BASE = {f.name: None for f in schemas.DECODED_LOGS.fields}


def logs(spark, *rows):
    full = [{**BASE, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.DECODED_LOGS.fields) for r in full],
                                 schemas.DECODED_LOGS)


def created(pool, block, li, t0="0x" + "100".rjust(40, "0"), t1="0x" + "105".rjust(40, "0"), tx="0xc"):
    return dict(chain_id=1, protocol="uniswap-v2", event_name="PairCreated", pool_address=pool, transaction_hash=tx,
                block_number=block, log_index=li, observed_at_ms=block * 1000, token0_address=t0, token1_address=t1)


def sync(pool, block, li, tx="0xs"):
    return dict(chain_id=1, protocol="uniswap-v2", event_name="Sync", pool_address=pool, transaction_hash=tx,
                block_number=block, log_index=li, observed_at_ms=block * 1000, reserve0="1", reserve1="2")


def test_repeated_creation_first_wins(spark):
    rows = logs(spark, created("0xnew", 20, 1, tx="0xlate", t0="0xlate0"), created("0xnew", 10, 5, tx="0xearly"))
    fp = enrich.first_pools(E.factory_events(E.routed_logs(rows))).collect()
    assert len(fp) == 1 and fp[0].created_tx == "0xearly" and fp[0].created_block == 10


def test_discovered_pool_counts_only_after_creation(spark, fx_dims):
    rows = logs(spark, sync("0xNEW", 9, 0, "0xa"), sync("0xnew", 10, 1, "0xb"), created("0xnew", 10, 2),
                sync("0xnew", 10, 3, "0xc"), sync("0xnew", 11, 0, "0xd"))
    ev = E.build_event_table(rows, fx_dims)
    kept = sorted(r.transaction_hash for r in ev.filter(F.col("event_type") == "sync").collect())
    assert kept == ["0xc", "0xd"]


def test_seed_pool_counts_from_start_and_wins_over_creation(spark, fx_dims):
    seed = "0x" + "1".rjust(40, "0")
    rows = logs(spark, sync(seed, 1, 0, "0xa"), created(seed, 5, 0, t0="0xother"), sync(seed, 6, 0, "0xb"))
    ev = E.build_event_table(rows, fx_dims).filter(F.col("event_type") == "sync").collect()
    assert len(ev) == 2
    # seed tokens (not the creation event's) are attached
    assert {r.token0_address for r in ev} == {"0x" + "101".rjust(40, "0")}


def test_seed_with_unresolved_token_is_rejected_then_discoverable(spark, fx_dims):
    p12 = "0x" + "12".rjust(40, "0")
    rows = logs(spark, sync(p12, 1, 0, "0xa"), created(p12, 5, 0), sync(p12, 6, 0, "0xb"))
    ev = E.build_event_table(rows, fx_dims).filter(F.col("event_type") == "sync").collect()
    assert [r.transaction_hash for r in ev] == ["0xb"]


def test_one_address_on_two_chains_is_two_pools(spark, fx_dims):
    on = lambda chain, row: {**row, "chain_id": chain, "protocol": "pancakeswap-v2"}
    t0 = "0x" + "101".rjust(40, "0")
    rows = logs(spark, on(1, created("0xp", 100, 1, tx="0xc1")), on(56, created("0xP", 900, 1, t0=t0, tx="0xc56")),
                on(1, sync("0xp", 500, 0, "0xa")), on(56, sync("0xp", 500, 0, "0xb")), on(56, sync("0xp", 950, 0, "0xc")))
    normalized = E.routed_logs(rows)
    assert enrich.first_pools(E.factory_events(normalized)).count() == 2
    got = {r.transaction_hash: r.token0_address for r in E.build_event_table(rows, fx_dims).collect() if r.event_type == "sync"}
    assert got == {"0xa": "0x" + "100".rjust(40, "0"), "0xc": t0}


def test_unknown_pool_is_dropped(spark, fx_dims):
    rows = logs(spark, sync("0xnowhere", 1, 0))
    assert E.build_event_table(rows, fx_dims).count() == 0


def test_token_fallback_levels(spark, fx_dims):
    meta = spark.createDataFrame([("0XA", "AAA", 9, None)], "address string, symbol string, decimals int, name string")
    pools = spark.createDataFrame(
        [("p", "0xa", "0x" + "104".rjust(40, "0")), ("q", "0x" + "101".rjust(40, "0"), "0x" + "107".rjust(40, "0"))],
        "pool string, token0_address string, token1_address string")
    out = {r.pool: r for r in enrich.resolve_pool_tokens(pools, fx_dims.known_tokens, meta).collect()}
    # fetched metadata wins; a missing name there is 'Unknown'; address case is ignored
    assert (out["p"].token0_symbol, out["p"].token0_decimals, out["p"].token0_name) == ("AAA", 9, "Unknown")
    # known-token table with a missing name -> ''
    assert (out["p"].token1_symbol, out["p"].token1_name) == ("TK4", "")
    assert (out["q"].token0_symbol, out["q"].token0_decimals, out["q"].token0_name) == ("TK1", 6, "Token 1")
    # nobody knows it
    assert (out["q"].token1_symbol, out["q"].token1_decimals, out["q"].token1_name) == ("UNKNOWN", 18, "Unknown Token")


def test_address_case_is_ignored_in_pool_join(spark, fx_dims):
    seed = "0x" + "1".rjust(40, "0")
    rows = logs(spark, sync(seed.upper().replace("0X", "0x"), 1, 0))
    assert E.build_event_table(rows, fx_dims).count() == 1


def test_large_pool_dimension_uses_shuffle_join(spark, fx_dims):
    """Above the row limit the pool dimension is not broadcast."""
    from helpers import plan_text
    rows = logs(spark, sync("0x" + "1".rjust(40, "0"), 1, 0))
    n = E.routed_logs(rows)
    dim = E.pool_dimension(n, fx_dims)
    small = enrich.attach_pools(E.pool_events(n), dim, max_broadcast_rows=1000)
    big = enrich.attach_pools(E.pool_events(n), dim, max_broadcast_rows=0)
    assert "BroadcastHashJoin" in plan_text(small)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(big)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    assert "SortMergeJoin" in text and big.count() == small.count() == 1
