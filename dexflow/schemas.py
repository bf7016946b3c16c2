"""Declared schemas: decoded logs in, pool/token dimensions, the stored event table."""

from __future__ import annotations

from pyspark.sql import types as T

# Integers wider than 63 bits (uint112 reserves, uint128 liquidity, uint160
# prices, (u)int256 amounts) stay decimal STRINGs end to end.
DECODED_LOGS = T.StructType([
    T.StructField("chain_id", T.IntegerType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("pool_address", T.StringType()),
    T.StructField("transaction_hash", T.StringType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("log_index", T.LongType()),
    T.StructField("observed_at_ms", T.LongType()),
    T.StructField("sender", T.StringType()),
    T.StructField("recipient", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("amount0_in", T.StringType()),
    T.StructField("amount1_in", T.StringType()),
    T.StructField("amount0_out", T.StringType()),
    T.StructField("amount1_out", T.StringType()),
    T.StructField("amount0", T.StringType()),
    T.StructField("amount1", T.StringType()),
    T.StructField("liquidity", T.StringType()),
    T.StructField("reserve0", T.StringType()),
    T.StructField("reserve1", T.StringType()),
    T.StructField("sqrt_price_x96", T.StringType()),
    T.StructField("tick", T.IntegerType()),
    T.StructField("tick_lower", T.IntegerType()),
    T.StructField("tick_upper", T.IntegerType()),
    T.StructField("token0_address", T.StringType()),
    T.StructField("token1_address", T.StringType()),
    T.StructField("fee", T.IntegerType()),
    T.StructField("tick_spacing", T.IntegerType()),
])

# The same with the contract that emitted the log, where the source has it.
DECODED_LOGS_WITH_EMITTER = T.StructType([*DECODED_LOGS.fields, T.StructField("emitter", T.StringType())])

POOL_SEED = T.StructType([
    T.StructField("protocol", T.StringType()),
    T.StructField("chain_id", T.IntegerType()),
    T.StructField("pool_address", T.StringType()),
    T.StructField("token0_address", T.StringType()),
    T.StructField("token1_address", T.StringType()),
])

TOKENS = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("decimals", T.ShortType()),
    T.StructField("name", T.StringType()),
])

# Stored table, column order as declared by the reference DDL, plus the
# partition column event_month (toYYYYMM of the event time).
PROTOCOL_EVENTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("transaction_hash", T.StringType()),
    T.StructField("log_index", T.LongType()),
    T.StructField("pool_address", T.StringType()),
    T.StructField("token0_address", T.StringType()),
    T.StructField("token0_symbol", T.StringType()),
    T.StructField("token0_decimals", T.ShortType()),
    T.StructField("token0_name", T.StringType()),
    T.StructField("token1_address", T.StringType()),
    T.StructField("token1_symbol", T.StringType()),
    T.StructField("token1_decimals", T.ShortType()),
    T.StructField("token1_name", T.StringType()),
    T.StructField("event_data", T.StringType()),
    T.StructField("gas_used", T.StringType()),
    T.StructField("gas_price", T.StringType()),
    T.StructField("fee", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("event_month", T.IntegerType()),
])

EVENT_COLUMNS = [f.name for f in PROTOCOL_EVENTS.fields]
# Sort key of the stored table (inside each month partition).
SORT_KEY = ["protocol", "event_type", "block_number", "transaction_hash", "log_index"]
