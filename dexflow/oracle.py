"""DuckDB oracle: the same answers written independently as plain SQL.

The driver runs these strings against DuckDB views of the input tables and
compares them with the Spark queries. They are written the way a SQL analyst
would (window functions, LEFT JOINs, string concatenation for JSON), not as a
translation of the Spark plans, so an error in one is unlikely to be repeated
in the other.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Inputs: FX2 decoded logs from ``events``, FX3 dimensions.
# ---------------------------------------------------------------------------

_FX2 = """
fx_b AS (
  SELECT event_id, user_id, event_type AS raw_type, user_id % 14 AS pool_no,
         epoch_us(ts) // 1000 AS ms,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
fx_c AS (
  SELECT *, CASE WHEN pool_no < 6 THEN 'uniswap-v2' WHEN pool_no < 10 THEN 'uniswap-v3' ELSE 'pancakeswap-v2' END AS protocol
  FROM fx_b),
fx_d AS (
  SELECT *, CASE raw_type WHEN 'click' THEN 'Swap'
      WHEN 'view' THEN CASE WHEN protocol = 'uniswap-v3' THEN 'Initialize' ELSE 'Sync' END
      WHEN 'purchase' THEN 'Mint' WHEN 'error' THEN 'Burn'
      ELSE CASE WHEN protocol = 'uniswap-v3' THEN 'PoolCreated' ELSE 'PairCreated' END END AS event_name,
    concat('0x', lpad(CAST(user_id AS VARCHAR), 40, '0')) AS who,
    concat(cents, repeat('0', 16)) AS amt,
    protocol = 'uniswap-v3' AS v3, event_id % 2 = 1 AS odd
  FROM fx_c),
decoded_logs AS (
SELECT CAST(CASE WHEN protocol = 'pancakeswap-v2' THEN 56 ELSE 1 END AS INT) AS chain_id, protocol, event_name,
  concat('0x', lpad(CAST(pool_no AS VARCHAR), 40, '0')) AS pool_address,
  concat('0x', lpad(CAST(event_id // 2 AS VARCHAR), 64, '0')) AS transaction_hash,
  CAST(18000000 + ms // 12000 - 142000000 AS BIGINT) AS block_number, CAST(event_id % 2 AS BIGINT) AS log_index,
  CAST(ms AS BIGINT) AS observed_at_ms,
  CASE WHEN event_name IN ('Swap', 'Mint') OR (event_name = 'Burn' AND NOT v3) THEN who END AS sender,
  CASE WHEN event_name = 'Swap' OR (event_name = 'Burn' AND NOT v3) THEN who END AS recipient,
  CASE WHEN event_name IN ('Mint', 'Burn') AND v3 THEN who END AS owner,
  CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN '0' ELSE amt END END AS amount0_in,
  CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN amt ELSE '0' END END AS amount1_in,
  CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN amt ELSE '0' END END AS amount0_out,
  CASE WHEN event_name = 'Swap' AND NOT v3 THEN CASE WHEN odd THEN '0' ELSE amt END END AS amount1_out,
  CASE WHEN event_name IN ('Mint', 'Burn') THEN amt
       WHEN event_name = 'Swap' AND v3 THEN CASE WHEN odd THEN concat('-', amt) ELSE amt END END AS amount0,
  CASE WHEN event_name IN ('Mint', 'Burn') THEN amt
       WHEN event_name = 'Swap' AND v3 THEN CASE WHEN odd THEN amt ELSE concat('-', amt) END END AS amount1,
  CASE WHEN event_name IN ('Mint', 'Burn') AND v3 THEN concat(cents, repeat('0', 34)) END AS liquidity,
  CASE WHEN event_name = 'Sync' THEN concat(cents, repeat('0', 26)) END AS reserve0,
  CASE WHEN event_name = 'Sync' THEN concat(cents, repeat('0', 27)) END AS reserve1,
  CASE WHEN v3 AND event_name IN ('Swap', 'Initialize') THEN concat(cents, repeat('0', 42)) END AS sqrt_price_x96,
  CAST(CASE WHEN v3 AND event_name IN ('Swap', 'Initialize') THEN k - 50 END AS INT) AS tick,
  CAST(CASE WHEN v3 AND event_name IN ('Mint', 'Burn') THEN -60 * k END AS INT) AS tick_lower,
  CAST(CASE WHEN v3 AND event_name IN ('Mint', 'Burn') THEN 60 * k END AS INT) AS tick_upper,
  CASE WHEN raw_type = 'signup' THEN concat('0x', lpad(CAST(100 + pool_no % 5 AS VARCHAR), 40, '0')) END AS token0_address,
  CASE WHEN raw_type = 'signup' THEN concat('0x', lpad(CAST(105 + pool_no % 3 AS VARCHAR), 40, '0')) END AS token1_address,
  CAST(CASE WHEN event_name = 'PoolCreated' THEN CASE k % 3 WHEN 0 THEN 500 WHEN 1 THEN 3000 ELSE 10000 END END AS INT) AS fee,
  CAST(CASE WHEN event_name = 'PoolCreated' THEN CASE k % 3 WHEN 0 THEN 10 WHEN 1 THEN 60 ELSE 200 END END AS INT) AS tick_spacing
FROM fx_d),
pool_seed AS (
  SELECT CASE WHEN id < 6 THEN 'uniswap-v2' WHEN id < 10 THEN 'uniswap-v3' ELSE 'pancakeswap-v2' END AS protocol,
    CAST(CASE WHEN id < 10 THEN 1 ELSE 56 END AS INT) AS chain_id,
    concat('0x', lpad(CAST(id AS VARCHAR), 40, '0')) AS pool_address,
    CASE WHEN id = 12 THEN NULL ELSE concat('0x', lpad(CAST(100 + id % 5 AS VARCHAR), 40, '0')) END AS token0_address,
    concat('0x', lpad(CAST(105 + id % 3 AS VARCHAR), 40, '0')) AS token1_address
  FROM range(13) t(id)),
token_known AS (
  SELECT concat('0x', lpad(CAST(100 + id AS VARCHAR), 40, '0')) AS address,
    concat('TK', CAST(id AS VARCHAR)) AS symbol,
    CAST(CASE id % 3 WHEN 0 THEN 18 WHEN 1 THEN 6 ELSE 8 END AS SMALLINT) AS decimals,
    CASE WHEN id = 4 THEN NULL ELSE concat('Token ', CAST(id AS VARCHAR)) END AS name
  FROM range(7) t(id))"""


# Routing, written out here so that a wrong entry of the library's tables shows as a difference.
_EVENT_TYPE = """CASE
      WHEN protocol IN ('uniswap-v2', 'pancakeswap-v2') THEN CASE event_name WHEN 'Swap' THEN 'swap' WHEN 'Mint' THEN 'mint'
        WHEN 'Burn' THEN 'burn' WHEN 'Sync' THEN 'sync' WHEN 'PairCreated' THEN 'pair_created' END
      WHEN protocol = 'uniswap-v3' THEN CASE event_name WHEN 'Swap' THEN 'swap' WHEN 'Mint' THEN 'mint'
        WHEN 'Burn' THEN 'burn' WHEN 'Initialize' THEN 'initialize' WHEN 'PoolCreated' THEN 'pool_created' END
    END"""
_KIND = f"CASE WHEN {_EVENT_TYPE} IN ('pair_created', 'pool_created') THEN 'factory' WHEN {_EVENT_TYPE} IS NOT NULL THEN 'pool' END"
_SUPPORTED = ("((chain = 1 AND protocol IN ('uniswap-v2', 'uniswap-v3', 'pancakeswap-v2')) "
              "OR (chain = 56 AND protocol = 'pancakeswap-v2'))")


def _json_field(key: str, expr: str) -> str:
    return f"coalesce(',\"{key}\":\"' || ({expr}) || '\"', '')"


# Payload fields of a normalised log, written per type as SQL CASEs.
_PAYLOAD_SQL = [
    ("sender", "CASE WHEN event_type = 'swap' THEN sender WHEN event_type = 'burn' AND version = 'v3' THEN owner "
               "WHEN event_type IN ('mint', 'burn') THEN sender END"),
    ("recipient", "CASE WHEN event_type = 'swap' THEN recipient END"),
    ("owner", "CASE WHEN event_type IN ('mint', 'burn') AND version = 'v3' THEN owner "
              "WHEN event_type IN ('mint', 'burn') THEN sender END"),
    ("amount0In", "CASE WHEN event_type = 'swap' AND version = 'v3' THEN "
                  "(CASE WHEN amount0 LIKE '-%' THEN '0' ELSE amount0 END) WHEN event_type = 'swap' THEN amount0_in END"),
    ("amount1In", "CASE WHEN event_type = 'swap' AND version = 'v3' THEN "
                  "(CASE WHEN amount1 LIKE '-%' THEN '0' ELSE amount1 END) WHEN event_type = 'swap' THEN amount1_in END"),
    ("amount0Out", "CASE WHEN event_type = 'swap' AND version = 'v3' THEN "
                   "(CASE WHEN amount0 LIKE '-%' THEN substr(amount0, 2) ELSE '0' END) WHEN event_type = 'swap' THEN amount0_out END"),
    ("amount1Out", "CASE WHEN event_type = 'swap' AND version = 'v3' THEN "
                   "(CASE WHEN amount1 LIKE '-%' THEN substr(amount1, 2) ELSE '0' END) WHEN event_type = 'swap' THEN amount1_out END"),
    ("amount0", "CASE WHEN event_type IN ('mint', 'burn') THEN amount0 END"),
    ("amount1", "CASE WHEN event_type IN ('mint', 'burn') THEN amount1 END"),
    ("liquidity", "CASE WHEN event_type IN ('mint', 'burn') AND version = 'v3' THEN liquidity "
                  "WHEN event_type IN ('mint', 'burn') THEN '0' END"),
    ("reserve0", "CASE WHEN event_type = 'sync' THEN reserve0 END"),
    ("reserve1", "CASE WHEN event_type = 'sync' THEN reserve1 END"),
    ("sqrtPriceX96", "CASE WHEN (event_type = 'swap' AND version = 'v3') OR event_type = 'initialize' THEN sqrt_price_x96 END"),
    ("tick", "CASE WHEN (event_type = 'swap' AND version = 'v3') OR event_type = 'initialize' THEN CAST(tick AS VARCHAR) END"),
    ("tickLower", "CASE WHEN event_type IN ('mint', 'burn') AND version = 'v3' THEN CAST(tick_lower AS VARCHAR) END"),
    ("tickUpper", "CASE WHEN event_type IN ('mint', 'burn') AND version = 'v3' THEN CAST(tick_upper AS VARCHAR) END"),
    ("fee", "CASE WHEN event_type IN ('pair_created', 'pool_created') THEN CAST(fee AS VARCHAR) END"),
    ("tickSpacing", "CASE WHEN event_type IN ('pair_created', 'pool_created') THEN CAST(tick_spacing AS VARCHAR) END"),
]

PAYLOAD_SQL = dict(_PAYLOAD_SQL)


def _json_sql() -> str:
    parts = ["'{\"type\":\"' || event_type || '\"'"] + [_json_field(k, e) for k, e in _PAYLOAD_SQL] + ["'}'"]
    return " || ".join(parts)


def _ms_to_seconds(col: str) -> str:
    return f"epoch_ms(({col} // 1000) * 1000)"


def _year_month(col: str) -> str:
    return f"CAST(year(epoch_ms({col})) * 100 + month(epoch_ms({col})) AS INT)"


# Pipeline CTEs after the inputs: routing, payload, pool dimension, event table.
_PIPELINE = f"""
routed AS (
  SELECT l.* REPLACE (coalesce(l.transaction_hash, 'tx-' || sha256(concat_ws('|', CAST(chain_id AS VARCHAR), pool_address,
             CAST(block_number AS VARCHAR), CAST(log_index AS VARCHAR), CAST(observed_at_ms AS VARCHAR)))) AS transaction_hash,
           coalesce(l.log_index, 0) AS log_index, coalesce(l.block_number, 0) AS block_number),
         CASE WHEN chain_id IN (1, 56) THEN chain_id ELSE 1 END AS chain,
         {_EVENT_TYPE} AS event_type, {_KIND} AS kind
  FROM decoded_logs l),
accepted AS (SELECT * FROM routed WHERE event_type IS NOT NULL AND {_SUPPORTED}),
rejected AS (
  SELECT *, CASE WHEN NOT {_SUPPORTED} THEN 'unsupported_protocol' ELSE 'unhandled_event' END AS reject_reason
  FROM routed WHERE event_type IS NULL OR NOT {_SUPPORTED}),
norm AS (
  SELECT *, {_json_sql()} AS event_data
  FROM (SELECT *, CASE WHEN protocol LIKE '%v2%' THEN 'v2' ELSE 'v3' END AS version FROM accepted)),
pool_candidates AS (
  SELECT lower(pool_address) AS pool_key, pool_address, protocol, chain_id, token0_address, token1_address,
         CAST(NULL AS INT) AS fee, CAST(NULL AS INT) AS tick_spacing, TRUE AS is_seed,
         CAST(NULL AS BIGINT) AS created_block, CAST(NULL AS BIGINT) AS created_log_index, CAST(NULL AS VARCHAR) AS created_tx
  FROM pool_seed WHERE token0_address IS NOT NULL AND token1_address IS NOT NULL
  UNION ALL
  SELECT lower(pool_address), pool_address, protocol, chain, token0_address, token1_address, fee, tick_spacing, FALSE,
         block_number, log_index, transaction_hash
  FROM norm WHERE kind = 'factory' AND pool_address IS NOT NULL),
known_pools AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY chain_id, pool_key
              ORDER BY CASE WHEN is_seed THEN 0 ELSE 1 END, created_block, created_log_index, created_tx) AS rn
    FROM pool_candidates) WHERE rn = 1),
first_pools AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY chain_id, pool_key ORDER BY created_block, created_log_index, created_tx) AS rn
    FROM pool_candidates WHERE NOT is_seed) WHERE rn = 1),
pool_dim AS (
  SELECT p.*, CASE WHEN p.protocol LIKE '%v2%' THEN 'v2' ELSE 'v3' END AS version,
    CASE WHEN k0.address IS NOT NULL THEN k0.symbol ELSE 'UNKNOWN' END AS token0_symbol,
    CAST(CASE WHEN k0.address IS NOT NULL THEN k0.decimals ELSE 18 END AS SMALLINT) AS token0_decimals,
    CASE WHEN k0.address IS NOT NULL THEN coalesce(k0.name, '') ELSE 'Unknown Token' END AS token0_name,
    CASE WHEN k1.address IS NOT NULL THEN k1.symbol ELSE 'UNKNOWN' END AS token1_symbol,
    CAST(CASE WHEN k1.address IS NOT NULL THEN k1.decimals ELSE 18 END AS SMALLINT) AS token1_decimals,
    CASE WHEN k1.address IS NOT NULL THEN coalesce(k1.name, '') ELSE 'Unknown Token' END AS token1_name
  FROM known_pools p
  LEFT JOIN token_known k0 ON lower(p.token0_address) = lower(k0.address)
  LEFT JOIN token_known k1 ON lower(p.token1_address) = lower(k1.address)),
pool_rows AS (
  SELECT e.*, p.protocol AS p_protocol, p.version AS p_version, p.pool_address AS p_pool_address,
         p.token0_address AS p_token0_address, p.token0_symbol AS p_token0_symbol,
         p.token0_decimals AS p_token0_decimals, p.token0_name AS p_token0_name,
         p.token1_address AS p_token1_address, p.token1_symbol AS p_token1_symbol,
         p.token1_decimals AS p_token1_decimals, p.token1_name AS p_token1_name, p.is_seed AS p_is_seed
  FROM norm e JOIN pool_dim p
    ON lower(e.pool_address) = p.pool_key AND e.chain = p.chain_id AND e.protocol = p.protocol
  WHERE e.kind = 'pool'
    AND (p.is_seed OR e.block_number > p.created_block
         OR (e.block_number = p.created_block AND e.log_index > p.created_log_index))),
pool_events_flat AS (
  SELECT transaction_hash || '-' || CAST(log_index AS VARCHAR) || '-' || event_type AS id,
    p_protocol AS protocol, p_version AS version, event_type, observed_at_ms AS timestamp, block_number,
    transaction_hash, log_index, p_pool_address AS pool_address,
    p_token0_address AS token0_address, p_token0_symbol AS token0_symbol, p_token0_decimals AS token0_decimals,
    coalesce(p_token0_name, '') AS token0_name,
    p_token1_address AS token1_address, p_token1_symbol AS token1_symbol, p_token1_decimals AS token1_decimals,
    coalesce(p_token1_name, '') AS token1_name,
    event_data, '' AS gas_used, '' AS gas_price, '' AS fee, {_year_month('observed_at_ms')} AS event_month
  FROM pool_rows),
factory_events_flat AS (
  SELECT 'factory-' || transaction_hash || '-' || CAST(log_index AS VARCHAR) || '-' || event_type AS id,
    protocol, version, event_type, observed_at_ms AS timestamp, block_number, transaction_hash,
    CAST(0 AS BIGINT) AS log_index, pool_address,
    token0_address, 'UNKNOWN' AS token0_symbol, CAST(18 AS SMALLINT) AS token0_decimals, 'Unknown Token' AS token0_name,
    token1_address, 'UNKNOWN' AS token1_symbol, CAST(18 AS SMALLINT) AS token1_decimals, 'Unknown Token' AS token1_name,
    event_data, '' AS gas_used, '' AS gas_price, coalesce(CAST(fee AS VARCHAR), '') AS fee,
    {_year_month('observed_at_ms')} AS event_month
  FROM norm WHERE kind = 'factory'),
protocol_events AS (
  SELECT * FROM pool_events_flat UNION ALL SELECT * FROM factory_events_flat)"""

BASE = "WITH " + _FX2.strip() + ",\n" + _PIPELINE.strip()

EVENT_COLUMNS_NO_CREATED = ("id, protocol, version, event_type, timestamp, block_number, transaction_hash, log_index, "
                            "pool_address, token0_address, token0_symbol, token0_decimals, token0_name, token1_address, "
                            "token1_symbol, token1_decimals, token1_name, event_data, gas_used, gas_price, fee, event_month")


def with_base(select: str, extra_ctes: str = "") -> str:
    """A full statement: the shared CTEs, optional extra CTEs, then the final SELECT."""
    extra = (",\n" + extra_ctes.strip()) if extra_ctes else ""
    return BASE + extra + "\n" + select.strip()


def with_repeated_addresses(statement: str) -> str:
    """The same statement over logs whose BSC pools have addresses of Ethereum pools, with Ethereum seeds alone."""
    return (statement.replace("concat('0x', lpad(CAST(pool_no AS VARCHAR), 40, '0')) AS pool_address",
                              "concat('0x', lpad(CAST(pool_no % 10 AS VARCHAR), 40, '0')) AS pool_address")
            .replace("FROM range(13) t(id)", "FROM range(10) t(id)"))


def ms_to_seconds(col: str) -> str:
    return _ms_to_seconds(col)


def hour_of(col: str) -> str:
    return f"date_trunc('hour', {_ms_to_seconds(col)})"


def iso_millis(col: str) -> str:
    return f"strftime(epoch_ms({col}), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def fee_label(col: str) -> str:
    frac = f"rtrim(lpad(CAST(abs({col}) % 10000 AS VARCHAR), 4, '0'), '0')"
    whole = f"CAST(abs({col}) // 10000 AS VARCHAR)"
    return (f"CASE WHEN {col} IS NULL THEN NULL ELSE (CASE WHEN {col} < 0 THEN '-' ELSE '' END) || {whole} || "
            f"(CASE WHEN {frac} = '' THEN '' ELSE '.' || {frac} END) || '%' END")
