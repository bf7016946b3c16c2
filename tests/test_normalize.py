"""FX4 edge cases: one assertion per normalisation rule, hand-written expectations."""

import json

from dexflow import schemas
from dexflow.functions import exprs as X
from dexflow.operators import normalize as N
from dexflow.plans import events as E
from helpers import plan_text

BASE = {f.name: None for f in schemas.DECODED_LOGS.fields}


def logs(spark, *rows):
    full = [{**BASE, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.DECODED_LOGS.fields) for r in full],
                                 schemas.DECODED_LOGS)


def v3_swap(a0, a1, **kw):
    return dict(chain_id=1, protocol="uniswap-v3", event_name="Swap", pool_address="0xp", transaction_hash="0xt",
                block_number=10, log_index=3, observed_at_ms=1_700_000_000_000, sender="0xs", recipient="0xr",
                amount0=a0, amount1=a1, sqrt_price_x96="79228162514264337593543950336", tick=-12, liquidity="5", **kw)


def payload(spark, *rows):
    out = E.routed_logs(logs(spark, *rows)).select(N.normalized_event_data().alias("j")).collect()
    return [json.loads(r.j) for r in out]


def test_signed_amount_split(spark):
    p = payload(spark, v3_swap("5", "-7"))[0]
    assert (p["amount0In"], p["amount0Out"], p["amount1In"], p["amount1Out"]) == ("5", "0", "0", "7")


def test_zero_amount(spark):
    p = payload(spark, v3_swap("0", "0"))[0]
    assert (p["amount0In"], p["amount0Out"]) == ("0", "0")


def test_widest_int256_kept_as_text(spark):
    digits = "5" * 77
    p = payload(spark, v3_swap("-" + digits, "1"))[0]
    assert p["amount0Out"] == digits and p["amount0In"] == "0"


def test_v3_swap_keeps_price_and_tick_drops_liquidity(spark):
    p = payload(spark, v3_swap("1", "-1"))[0]
    assert p["sqrtPriceX96"] == "79228162514264337593543950336" and p["tick"] == "-12"
    assert "liquidity" not in p


def test_v2_mint_owner_is_sender_liquidity_zero(spark):
    p = payload(spark, dict(chain_id=1, protocol="uniswap-v2", event_name="Mint", pool_address="0xp",
                            transaction_hash="0xt", block_number=1, log_index=1, observed_at_ms=1, sender="0xs",
                            amount0="1", amount1="2"))[0]
    assert p == {"type": "mint", "sender": "0xs", "owner": "0xs", "amount0": "1", "amount1": "2", "liquidity": "0"}


def test_v2_burn_drops_to(spark):
    p = payload(spark, dict(chain_id=1, protocol="uniswap-v2", event_name="Burn", pool_address="0xp",
                            transaction_hash="0xt", block_number=1, log_index=1, observed_at_ms=1, sender="0xs",
                            recipient="0xto", amount0="1", amount1="2"))[0]
    assert p == {"type": "burn", "sender": "0xs", "owner": "0xs", "amount0": "1", "amount1": "2", "liquidity": "0"}


def test_v3_burn_sender_is_owner(spark):
    p = payload(spark, dict(chain_id=1, protocol="uniswap-v3", event_name="Burn", pool_address="0xp",
                            transaction_hash="0xt", block_number=1, log_index=1, observed_at_ms=1, owner="0xo",
                            amount0="1", amount1="2", liquidity="9", tick_lower=-60, tick_upper=60))[0]
    assert p == {"type": "burn", "sender": "0xo", "owner": "0xo", "amount0": "1", "amount1": "2", "liquidity": "9",
                 "tickLower": "-60", "tickUpper": "60"}


def test_v2_sync_and_swap_have_no_tick_keys(spark):
    out = payload(spark,
                  dict(chain_id=1, protocol="uniswap-v2", event_name="Sync", pool_address="0xp", transaction_hash="0xt",
                       block_number=1, log_index=1, observed_at_ms=1, reserve0="3", reserve1="4"),
                  dict(chain_id=1, protocol="uniswap-v2", event_name="Swap", pool_address="0xp", transaction_hash="0xt",
                       block_number=1, log_index=2, observed_at_ms=1, sender="0xs", recipient="0xr", amount0_in="1",
                       amount1_in="0", amount0_out="0", amount1_out="2"))
    assert {"type": "sync", "reserve0": "3", "reserve1": "4"} in out
    swap = [p for p in out if p["type"] == "swap"][0]
    assert "tick" not in swap and "sqrtPriceX96" not in swap and swap["recipient"] == "0xr"


def test_initialize(spark):
    p = payload(spark, dict(chain_id=1, protocol="uniswap-v3", event_name="Initialize", pool_address="0xp",
                            transaction_hash="0xt", block_number=1, log_index=0, observed_at_ms=1,
                            sqrt_price_x96="1" * 49, tick=7))[0]
    assert p == {"type": "initialize", "sqrtPriceX96": "1" * 49, "tick": "7"}


def test_log_index_zero_is_kept_and_missing_hash_is_deterministic(spark):
    rows = logs(spark, {**v3_swap("1", "-1"), "log_index": 0, "transaction_hash": None})
    a = E.routed_logs(rows).select("transaction_hash", "log_index").collect()
    b = E.routed_logs(rows).select("transaction_hash", "log_index").collect()
    assert a == b and a[0].log_index == 0 and a[0].transaction_hash.startswith("tx-")


def test_version_rule(spark):
    df = spark.createDataFrame([("pancakeswap-v2",), ("uniswap-v3",), ("uniswap-v2",)], "protocol string")
    got = {r.protocol: r.v for r in df.select("protocol", N.version_column("protocol").alias("v")).collect()}
    assert got == {"pancakeswap-v2": "v2", "uniswap-v3": "v3", "uniswap-v2": "v2"}


def test_unsupported_pair_and_unhandled_event_are_rejected(spark):
    rows = logs(spark,
                {**v3_swap("1", "-1"), "chain_id": 56},                       # uniswap-v3 is not on chain 56
                {**v3_swap("1", "-1"), "event_name": "Collect"},              # declared, no handler
                {**v3_swap("1", "-1"), "chain_id": 137},                      # unknown chain -> Ethereum, accepted
                v3_swap("1", "-1"))
    acc = N.route_supported(rows).count()
    rej = {r.reject_reason for r in N.route_rejected(rows).collect()}
    assert acc == 2 and N.route_rejected(rows).count() == 2
    assert rej == {"unsupported_protocol", "unhandled_event"}


def test_factory_rows(spark):
    rows = logs(spark,
                dict(chain_id=1, protocol="uniswap-v2", event_name="PairCreated", pool_address="0xnew",
                     transaction_hash="0xt", block_number=5, log_index=4, observed_at_ms=1, token0_address="0xa",
                     token1_address="0xb"),
                dict(chain_id=1, protocol="uniswap-v3", event_name="PoolCreated", pool_address="0xnew3",
                     transaction_hash="0xu", block_number=5, log_index=5, observed_at_ms=1, token0_address="0xa",
                     token1_address="0xb", fee=3000, tick_spacing=60))
    out = {r.event_type: r for r in E.flatten_factory_events(E.factory_events(E.routed_logs(rows))).collect()}
    pair, pool = out["pair_created"], out["pool_created"]
    assert (pair.token0_symbol, pair.token0_decimals, pair.token0_name, pair.log_index, pair.fee) == \
        ("UNKNOWN", 18, "Unknown Token", 0, "")
    assert json.loads(pair.event_data) == {"type": "pair_created"}
    assert pool.fee == "3000" and json.loads(pool.event_data) == {"type": "pool_created", "fee": "3000",
                                                                  "tickSpacing": "60"}
    assert pool.id == "factory-0xu-5-pool_created"


def test_fee_tier_label(spark):
    df = spark.createDataFrame([(500,), (3000,), (10000,), (100,), (None,)], "fee int")
    got = [r.l for r in df.select(X.fee_tier_label("fee").alias("l")).collect()]
    assert got == ["0.05%", "0.3%", "1%", "0.01%", None]


def test_time_helpers(spark):
    df = spark.createDataFrame([(1704067207179,)], "ms bigint")
    r = df.select(X.seconds_time("ms").cast("string").alias("s"), X.hour_start("ms").cast("string").alias("h"),
                  X.year_month("ms").alias("m"), X.iso_millis("ms").alias("iso")).first()
    assert (r.s, r.h, r.m, r.iso) == ("2024-01-01 00:00:07", "2024-01-01 00:00:00", 202401, "2024-01-01T00:00:07.179Z")


def test_event_summary(spark):
    df = spark.createDataFrame([("swap", '{"type":"swap","amount0In":"5","amount1Out":"7"}', "A", "B"),
                                ("initialize", '{"type":"initialize","sqrtPriceX96":"9","tick":"-1"}', "A", "B")],
                               "event_type string, event_data string, token0_symbol string, token1_symbol string")
    got = [r.s for r in df.select(N.event_summary().alias("s")).collect()]
    assert got == ["Swap: 5 A → 7 B", "Pool Initialized: Price 9, Tick -1"]


def test_no_python_udf_in_normalisation(spark):
    rows = logs(spark, v3_swap("1", "-1"))
    plan = plan_text(E.routed_logs(rows).select(N.normalized_event_data()))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_signed_split_property(spark):
    """For any signed integer text: exactly one side is non-zero (or both '0'), digits unchanged."""
    from hypothesis import given, settings, strategies as st

    values = []

    @settings(max_examples=200, deadline=None)
    @given(st.integers(min_value=-(2 ** 255), max_value=2 ** 255 - 1))
    def collect(v):
        values.append(str(v))

    collect()
    df = spark.createDataFrame([(v,) for v in values], "a string")
    out = df.select("a", X.signed_in("a").alias("i"), X.signed_out("a").alias("o")).collect()
    for r in out:
        if r.a.startswith("-"):
            assert (r.i, r.o) == ("0", r.a[1:])
        else:
            assert (r.i, r.o) == (r.a, "0")


def test_fee_tier_label_property(spark):
    """fee / 10000 printed like a JavaScript number (shortest text, no trailing '.0') plus '%'."""
    from hypothesis import given, settings, strategies as st

    fees = []

    @settings(max_examples=300, deadline=None)
    @given(st.integers(min_value=0, max_value=10 ** 7))
    def collect(v):
        fees.append(v)

    collect()

    def js_like(fee: int) -> str:
        text = repr(fee / 10000)
        return (text[:-2] if text.endswith(".0") else text) + "%"

    df = spark.createDataFrame([(f,) for f in fees], "fee int")
    for r in df.select("fee", X.fee_tier_label("fee").alias("label")).collect():
        assert r.label == js_like(r.fee), r.fee
