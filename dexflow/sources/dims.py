"""Constant dimensions (O-03, O-31, O-32) as small DataFrames and expressions.

Everything in this module is a fixed-size constant: broadcasting these tables
is safe at any data scale because their size does not grow with the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------

PROTOCOLS = ["uniswap-v2", "uniswap-v3", "pancakeswap-v2"]
EVENT_TYPES = ["swap", "mint", "burn", "sync", "initialize", "collect", "flash"]
FACTORY_EVENT_TYPES = ["pair_created", "pool_created"]

ETHEREUM_CHAIN_ID = 1
BSC_CHAIN_ID = 56

# Factory and router contracts per chain and protocol.
CONTRACT_ADDRESSES = [
    # (chain_id, protocol, factory, router)
    (1, "uniswap-v2", "0x5C69bEe701ef814a2B6a3EDD4B1652CB9cc5aA6f", "0x7a250d5630B4cF539739dF2C5dAcb4c659F2488D"),
    (1, "uniswap-v3", "0x1F98431c8aD98523631AE4a59f267346ea31F984", "0xE592427A0AEce92De3Edee1F18E0157C05861564"),
    (1, "pancakeswap-v2", "0xcA143Ce0Fe65960e6Aa4D42C8d3cE161c2B6604f", "0x10ED43C718714eb63d5aA57B78B54704E256024E"),
    (56, "pancakeswap-v2", "0xcA143Ce0Fe65960e6Aa4D42C8d3cE161c2B6604f", "0x10ED43C718714eb63d5aA57B78B54704E256024E"),
]

# Which decoded event each protocol listens to, and what it becomes.
# (protocol, event_name, event_type, kind)
EVENT_DISPATCH = [
    ("uniswap-v2", "Swap", "swap", "pool"),
    ("uniswap-v2", "Mint", "mint", "pool"),
    ("uniswap-v2", "Burn", "burn", "pool"),
    ("uniswap-v2", "Sync", "sync", "pool"),
    ("uniswap-v2", "PairCreated", "pair_created", "factory"),
    ("pancakeswap-v2", "Swap", "swap", "pool"),
    ("pancakeswap-v2", "Mint", "mint", "pool"),
    ("pancakeswap-v2", "Burn", "burn", "pool"),
    ("pancakeswap-v2", "Sync", "sync", "pool"),
    ("pancakeswap-v2", "PairCreated", "pair_created", "factory"),
    ("uniswap-v3", "Initialize", "initialize", "pool"),
    ("uniswap-v3", "Swap", "swap", "pool"),
    ("uniswap-v3", "Mint", "mint", "pool"),
    ("uniswap-v3", "Burn", "burn", "pool"),
    ("uniswap-v3", "PoolCreated", "pool_created", "factory"),
]

# Pools watched from the start, with the token addresses used when the pool
# contract cannot be asked. (protocol, pool, token0, token1)
SEED_POOLS = [
    ("uniswap-v2", "0xB4e16d0168e52d35CaCD2c6185b44281Ec28C9Dc", "0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v2", "0x0d4a11d5EEaaC28EC3F61d100daF4d40471f1852", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2", "0xdAC17F958D2ee523a2206206994597C13D831ec7"),
    ("uniswap-v2", "0xA478c2975Ab1Ea89e8196811F51A7B7Ade33eB11", "0x1f9840a85d5aF5bf1D1762F925BDADdC4201F984", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v2", "0xBb2b8038a1640196FbE3e38816F3e67Cba72D940", "0x2260FAC5E5542a773Aa44fBCfeDf7C193bc2C599", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v2", "0x2fDbAdf3C4D5A8666Bc06645B8358ab803996E28", "0x6B175474E89094C44Da98b954EedeAC495271d0F", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v2", "0x43AE24960e5534731Fc831386c07755A2dc33D47", "0x514910771AF9Ca656af840dff83E8264EcF986CA", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v3", "0x88e6A0c2dDD26FEEb64F039a2c41296FcB3f5640", "0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v3", "0x11b815efB8f581194ae79006d24E0d814B7697F6", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2", "0xdAC17F958D2ee523a2206206994597C13D831ec7"),
    ("uniswap-v3", "0x1d42064Fc4Beb5F8aAF85F4617AE8b3b5B8Bd801", "0x1f9840a85d5aF5bf1D1762F925BDADdC4201F984", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("uniswap-v3", "0xCBCdF9626bC03E24f779434178A73a0B4bad62eD", "0x2260FAC5E5542a773Aa44fBCfeDf7C193bc2C599", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("pancakeswap-v2", "0x7213a321F1855CF1779f42c0CD85d3D95291D34C", "0xbb4CdB9CBd36B01bD1cBaEBF2De08d9173bc095c", "0xe9e7CEA3DedcA5984780Bafc599bD69ADd087D56"),
    ("pancakeswap-v2", "0x58F876857a02D6762E0101bb5C46A8c1ED44Dc16", "0xbb4CdB9CBd36B01bD1cBaEBF2De08d9173bc095c", "0xe9e7CEA3DedcA5984780Bafc599bD69ADd087D56"),
    ("pancakeswap-v2", "0x74E4716E431f45807DCF4f3fA29A161f9F79019e", "0xbb4CdB9CBd36B01bD1cBaEBF2De08d9173bc095c", "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"),
    ("pancakeswap-v2", "0x61EB789d75A95CAa3fF5ed22AB22bD1b5E2b9E32", "0x0E09FaBB73Bd3Ade0a17ECC321fD13a19e81cE82", "0xbb4CdB9CBd36B01bD1cBaEBF2De08d9173bc095c"),
]

# Token details used when the token contract cannot be asked.
# (address, symbol, decimals, name)
KNOWN_TOKENS = [
    ("0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2", "WETH", 18, "Wrapped Ether"),
    ("0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48", "USDC", 6, "USD Coin"),
    ("0xdAC17F958D2ee523a2206206994597C13D831ec7", "USDT", 6, "Tether USD"),
    ("0x6B175474E89094C44Da98b954EedeAC495271d0F", "DAI", 18, "Dai Stablecoin"),
    ("0x2260FAC5E5542a773Aa44fBCfeDf7C193bc2C599", "WBTC", 8, "Wrapped BTC"),
    ("0x1f9840a85d5aF5bf1D1762F925BDADdC4201F984", "UNI", 18, "Uniswap"),
    ("0x514910771AF9Ca656af840dff83E8264EcF986CA", "LINK", 18, "ChainLink Token"),
    ("0x0bc529c00C6401aEF6D220BE8C6Ea1667F6Ad93e", "YFI", 18, "yearn.finance"),
    ("0xC011a73ee8576Fb46F5E1c5751cA3B9Fe0af2a6F", "SNX", 18, "Synthetix Network Token"),
    ("0xbb4CdB9CBd36B01bD1cBaEBF2De08d9173bc095c", "WBNB", 18, "Wrapped BNB"),
    ("0xe9e7CEA3DedcA5984780Bafc599bD69ADd087D56", "BUSD", 18, "BUSD Token"),
    ("0x0E09FaBB73Bd3Ade0a17ECC321fD13a19e81cE82", "CAKE", 18, "PancakeSwap Token"),
    ("0x2170Ed0880ac9A755fd29B2688956BD959F933F8", "ETH", 18, "Ethereum Token"),
    ("0x55d398326f99059fF775485246999027B3197955", "USDT", 18, "Tether USD"),
    ("0x7130d2A12B9BCbFAe4f2634d864A1Ee1Ce3Ead9c", "BTCB", 18, "Bitcoin BEP2"),
]

# Keys of the stored JSON payload (event_data), in output order. Each event
# type fills a subset; absent keys are left out.
PAYLOAD_KEYS = ["type", "sender", "recipient", "owner", "amount0In", "amount1In", "amount0Out", "amount1Out",
                "amount0", "amount1", "liquidity", "reserve0", "reserve1", "sqrtPriceX96", "tick",
                "tickLower", "tickUpper", "fee", "tickSpacing"]

# One-line text of a stored event per type: {key} is a payload value,
# {symbol0}/{symbol1} the token symbols.
SUMMARY_FORMATS = {
    "swap": "Swap: {amount0In} {symbol0} → {amount1Out} {symbol1}",
    "mint": "Liquidity Added: {amount0} {symbol0} + {amount1} {symbol1}",
    "burn": "Liquidity Removed: {amount0} {symbol0} + {amount1} {symbol1}",
    "sync": "Reserves Updated: {reserve0} {symbol0} / {reserve1} {symbol1}",
    "initialize": "Pool Initialized: Price {sqrtPriceX96}, Tick {tick}",
}

# Id prefix of pool-creation rows.
FACTORY_ID_PREFIX = "factory"

# Token details when no source knows the token.
UNKNOWN_SYMBOL = "UNKNOWN"
UNKNOWN_DECIMALS = 18
UNKNOWN_NAME = "Unknown Token"
# Name when the token answers symbol/decimals but has no name().
MISSING_NAME = "Unknown"

# ---------------------------------------------------------------------------
# Expressions built from the constants (no join needed, pushed into scans).
# ---------------------------------------------------------------------------


def supported_pairs() -> list[tuple[int, str]]:
    return sorted({(chain, protocol) for chain, protocol, _, _ in CONTRACT_ADDRESSES})


def effective_chain(chain_id: Column) -> Column:
    """Unknown chains fall back to Ethereum."""
    known = [ETHEREUM_CHAIN_ID, BSC_CHAIN_ID]
    return F.when(chain_id.isin(known), chain_id).otherwise(F.lit(ETHEREUM_CHAIN_ID))


def is_supported(chain_id: Column, protocol: Column) -> Column:
    """(chain, protocol) is in the support matrix: one InSet test on a combined key."""
    keys = [f"{c}|{p}" for c, p in supported_pairs()]
    return F.coalesce(F.concat_ws("|", chain_id.cast("string"), protocol).isin(keys), F.lit(False))


def dispatch(protocol: Column, event_name: Column) -> Column:
    """Event type of (protocol, event_name); NULL when the protocol does not handle that event.

    One lookup in a literal map keyed by ``protocol|event_name`` (a single
    expression, so pushing a filter on it below other projections stays cheap).
    """
    pairs = []
    for p, e, event_type, _ in EVENT_DISPATCH:
        pairs += [F.lit(f"{p}|{e}"), F.lit(event_type)]
    return F.try_element_at(F.create_map(*pairs), F.concat_ws("|", protocol, event_name))


def factory_contract(chain: Column, protocol: Column) -> Column:
    """The lower-cased address of the factory of (chain, protocol); NULL if there is none."""
    pairs = [F.lit(x) for c, p, factory, _ in CONTRACT_ADDRESSES for x in (f"{c}|{p}", factory.lower())]
    return F.try_element_at(F.create_map(*pairs), F.concat_ws("|", chain.cast("string"), protocol))


def kind_of(event_type: Column) -> Column:
    """'factory' for pool-creation types, 'pool' for the other handled types."""
    return (F.when(event_type.isin(*FACTORY_EVENT_TYPES), F.lit("factory"))
             .when(event_type.isNotNull(), F.lit("pool")))


def version_of(protocol: Column) -> Column:
    """Protocol text containing 'v2' is version v2, anything else v3."""
    return F.when(protocol.contains("v2"), F.lit("v2")).otherwise(F.lit("v3"))


# ---------------------------------------------------------------------------
# Constant tables.
# ---------------------------------------------------------------------------


def contract_addresses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONTRACT_ADDRESSES, "chain_id int, protocol string, factory string, router string")


def dispatch_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_DISPATCH, "protocol string, event_name string, event_type string, kind string")


def seed_pools(spark: SparkSession) -> DataFrame:
    """The 14 watched pools in the POOL_SEED shape (chain from the protocol)."""
    rows = [(p, BSC_CHAIN_ID if p == "pancakeswap-v2" else ETHEREUM_CHAIN_ID, a, t0, t1) for p, a, t0, t1 in SEED_POOLS]
    return spark.createDataFrame(rows, schemas.POOL_SEED)


def known_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN_TOKENS, "address string, symbol string, decimals int, name string") \
        .withColumn("decimals", F.col("decimals").cast("smallint"))
