"""Test inputs derived from the driver tables (FX2) and the fixture dimensions (FX3).

``decoded_logs`` is a pure projection of ``events``: one narrow pass, no
shuffle, so it scales with the events table and keeps its partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dims
from .tables import read_table

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


# FX2 as Spark SQL expressions, step by step (FIXTURES.md). The epoch
# milliseconds are taken from the TIMESTAMP_NTZ column directly.
_FX2_B = [
    "event_id", "user_id", "event_type AS raw_type", "user_id % 14 AS pool_no",
    f"timestampdiff(MILLISECOND, {EPOCH_NTZ}, ts) AS ms",
    "CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS cents",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
]
_FX2_C = ["*", "CASE WHEN pool_no < 6 THEN 'uniswap-v2' WHEN pool_no < 10 THEN 'uniswap-v3' "
               "ELSE 'pancakeswap-v2' END AS protocol"]
_FX2_D = [
    "*",
    """CASE raw_type WHEN 'click' THEN 'Swap'
         WHEN 'view' THEN CASE WHEN protocol = 'uniswap-v3' THEN 'Initialize' ELSE 'Sync' END
         WHEN 'purchase' THEN 'Mint' WHEN 'error' THEN 'Burn'
         ELSE CASE WHEN protocol = 'uniswap-v3' THEN 'PoolCreated' ELSE 'PairCreated' END END AS event_name""",
    "concat('0x', lpad(CAST(user_id AS STRING), 40, '0')) AS who",
    "concat(cents, repeat('0', 16)) AS amt",
    "protocol = 'uniswap-v3' AS v3",
    "event_id % 2 = 1 AS odd",
]
_FX2_OUT = [
    "CAST(CASE WHEN protocol = 'pancakeswap-v2' THEN 56 ELSE 1 END AS INT) AS chain_id",
    "protocol", "event_name",
    "concat('0x', lpad(CAST(pool_no AS STRING), 40, '0')) AS pool_address",
    "concat('0x', lpad(CAST(event_id div 2 AS STRING), 64, '0')) AS transaction_hash",
    "CAST(18000000 + ms div 12000 - 142000000 AS BIGINT) AS block_number",
    "CAST(event_id % 2 AS BIGINT) AS log_index",
    "CAST(ms AS BIGINT) AS observed_at_ms",
    "CASE WHEN event_name IN ('Swap', 'Mint') OR (event_name = 'Burn' AND NOT v3) THEN who END AS sender",
    "CASE WHEN event_name = 'Swap' OR (event_name = 'Burn' AND NOT v3) THEN who END AS recipient",
    "CASE WHEN event_name IN ('Mint', 'Burn') AND v3 THEN who END AS owner",
    "CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN '0' ELSE amt END END AS amount0_in",
    "CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN amt ELSE '0' END END AS amount1_in",
    "CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN amt ELSE '0' END END AS amount0_out",
    "CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN '0' ELSE amt END END AS amount1_out",
    """CASE WHEN event_name IN ('Mint', 'Burn') THEN amt
         WHEN event_name = 'Swap' AND v3 THEN CASE WHEN odd THEN concat('-', amt) ELSE amt END END AS amount0""",
    """CASE WHEN event_name IN ('Mint', 'Burn') THEN amt
         WHEN event_name = 'Swap' AND v3 THEN CASE WHEN odd THEN amt ELSE concat('-', amt) END END AS amount1""",
    "CASE WHEN event_name IN ('Mint', 'Burn') AND v3 THEN concat(cents, repeat('0', 34)) END AS liquidity",
    "CASE WHEN event_name = 'Sync' THEN concat(cents, repeat('0', 26)) END AS reserve0",
    "CASE WHEN event_name = 'Sync' THEN concat(cents, repeat('0', 27)) END AS reserve1",
    "CASE WHEN v3 AND event_name IN ('Swap', 'Initialize') THEN concat(cents, repeat('0', 42)) END AS sqrt_price_x96",
    "CAST(CASE WHEN v3 AND event_name IN ('Swap', 'Initialize') THEN k - 50 END AS INT) AS tick",
    "CAST(CASE WHEN v3 AND event_name IN ('Mint', 'Burn') THEN -60 * k END AS INT) AS tick_lower",
    "CAST(CASE WHEN v3 AND event_name IN ('Mint', 'Burn') THEN 60 * k END AS INT) AS tick_upper",
    "CASE WHEN raw_type = 'signup' THEN concat('0x', lpad(CAST(100 + pool_no % 5 AS STRING), 40, '0')) END AS token0_address",
    "CASE WHEN raw_type = 'signup' THEN concat('0x', lpad(CAST(105 + pool_no % 3 AS STRING), 40, '0')) END AS token1_address",
    """CAST(CASE WHEN event_name = 'PoolCreated' THEN CASE k % 3 WHEN 0 THEN 500 WHEN 1 THEN 3000 ELSE 10000 END END
         AS INT) AS fee""",
    """CAST(CASE WHEN event_name = 'PoolCreated' THEN CASE k % 3 WHEN 0 THEN 10 WHEN 1 THEN 60 ELSE 200 END END
         AS INT) AS tick_spacing""",
]


def decoded_logs_from_events(events: DataFrame) -> DataFrame:
    """FX2: map each ``events`` row to one decoded contract log (one narrow projection chain)."""
    return events.selectExpr(*_FX2_B).selectExpr(*_FX2_C).selectExpr(*_FX2_D).selectExpr(*_FX2_OUT)


def decoded_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_logs_from_events(read_table(spark, sf_dir, "events"))


def repeat_addresses(logs: DataFrame) -> DataFrame:
    """FX2 with the addresses of Ethereum pools 0..3 given to the BSC pools 10..13 as well."""
    shared = F.overlay("pool_address", F.lit("0"), F.lit(41), F.lit(1))
    return logs.withColumn("pool_address", F.when(F.col("chain_id") == 56, shared).otherwise(F.col("pool_address")))


MONTH_MS = 31 * 86_400_000

#: A contract that is no factory.
FOREIGN = "0x" + "f" * 40


def spread_over_months(logs: DataFrame) -> DataFrame:
    """FX2 over several months: by the block's remainder, a log is up to three times 31 days older."""
    return logs.withColumn("observed_at_ms", F.col("observed_at_ms") - F.col("block_number") % 4 * MONTH_MS)


def with_emitters(logs: DataFrame) -> DataFrame:
    """FX2 with the emitting contract: pools for pool logs; for creation logs the factory, every third block another contract, or none."""
    chain = F.col("chain_id").cast("string")
    factory = F.create_map(*[F.lit(x) for c, p, f, _ in dims.CONTRACT_ADDRESSES for x in (f"{c}|{p}", f)])
    made = (F.when(F.col("block_number") % 3 == 0, FOREIGN).when(F.col("block_number") % 7 == 1, F.lit(None))
             .otherwise(F.try_element_at(factory, F.concat_ws("|", chain, "protocol"))))
    return logs.withColumn("emitter", F.when(F.col("event_name").isin("PairCreated", "PoolCreated"), made).otherwise(F.col("pool_address")))


def mixed_routing(logs: DataFrame) -> DataFrame:
    """FX2 with logs that no route takes: other events and protocols, a protocol on the wrong chain, and an unknown chain."""
    k = F.col("block_number") % 6
    return logs.withColumns({"event_name": F.when(k == 0, "Collect").otherwise(F.col("event_name")),
                             "protocol": F.when(k == 1, "sushiswap").otherwise(F.col("protocol")),
                             "chain_id": F.when(k == 2, 56).when(k == 3, 137).when(k == 4, F.lit(None)).otherwise(F.col("chain_id"))})


def delivered_again(logs: DataFrame) -> DataFrame:
    """FX2 with every fourth block twice."""
    return logs.unionByName(logs.filter(F.col("block_number") % 4 == 0))


def without_metadata(logs: DataFrame) -> DataFrame:
    """FX2 with holes: no hash, no index, no block, by the remainder of the time."""
    t = F.col("observed_at_ms")
    hole = lambda c, k: F.when(t % k == 0, F.lit(None)).otherwise(F.col(c))
    return logs.withColumns({"transaction_hash": hole("transaction_hash", 5), "log_index": hole("log_index", 7), "block_number": hole("block_number", 11)})


def mainnet(logs: DataFrame) -> DataFrame:
    """FX2 on the watched pools: pool i is the i-th seed pool, token 100 + i the i-th known token, in lower case."""
    number = F.substring("pool_address", -2, 2).cast("int")
    pools = F.array(*[F.lit(a) for _, a, _, _ in dims.SEED_POOLS])
    tokens = F.array(*[F.lit(t[0].lower()) for t in dims.KNOWN_TOKENS])
    token = lambda c: F.get(tokens, F.substring(c, -3, 3).cast("int") - 100)
    return logs.withColumns({"pool_address": F.get(pools, number), "token0_address": token("token0_address"), "token1_address": token("token1_address")})


def contract_answers(logs: DataFrame) -> DataFrame:
    """What pool contracts answer: the tokens of the first creation log of every pool with an odd number; of pool 5 one token only."""
    made = logs.filter(F.col("token0_address").isNotNull() & (F.substring("pool_address", -1, 1).cast("int") % 2 == 1))
    first = F.min_by(F.struct("token0_address", "token1_address"), F.struct("block_number", "log_index", "transaction_hash")).alias("t")
    out = made.groupBy("chain_id", "pool_address").agg(first).select("chain_id", "pool_address", "t.*")
    return out.withColumn("token0_address", F.when(F.col("pool_address").endswith("05"), F.lit(None)).otherwise(F.col("token0_address")))


def pool_seed(spark: SparkSession) -> DataFrame:
    """FX3 seed pools: 13 pools; pool 12 has an unresolved token0, pool 13 is not a seed."""
    return spark.range(13).selectExpr(
        "CASE WHEN id < 6 THEN 'uniswap-v2' WHEN id < 10 THEN 'uniswap-v3' ELSE 'pancakeswap-v2' END AS protocol",
        "CAST(CASE WHEN id < 10 THEN 1 ELSE 56 END AS INT) AS chain_id",
        "concat('0x', lpad(CAST(id AS STRING), 40, '0')) AS pool_address",
        "CASE WHEN id = 12 THEN CAST(NULL AS STRING) "
        "ELSE concat('0x', lpad(CAST(100 + id % 5 AS STRING), 40, '0')) END AS token0_address",
        "concat('0x', lpad(CAST(105 + id % 3 AS STRING), 40, '0')) AS token1_address",
    )


def token_known(spark: SparkSession) -> DataFrame:
    """FX3 known tokens: 100..106; 104 has no name, 107 is absent."""
    return spark.range(7).selectExpr(
        "concat('0x', lpad(CAST(100 + id AS STRING), 40, '0')) AS address",
        "concat('TK', CAST(id AS STRING)) AS symbol",
        "CAST(CASE id % 3 WHEN 0 THEN 18 WHEN 1 THEN 6 ELSE 8 END AS SMALLINT) AS decimals",
        "CASE WHEN id = 4 THEN CAST(NULL AS STRING) ELSE concat('Token ', CAST(id AS STRING)) END AS name",
    )
