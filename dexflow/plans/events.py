"""From decoded logs to rows of the event table (O-09, O-10, O-26, O-27, O-36, O-40).

``build_event_table`` declares the whole plan lazily; Catalyst prunes what a
report does not need (a count never builds the JSON payload) and pushes the
event filters into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import exprs as X
from ..operators import enrich, normalize
from ..sources import dims


@dataclass
class Dimensions:
    """Inputs that are not events: seed pools, the known-token table, optional fetched token metadata and pool tokens."""
    seeds: DataFrame
    known_tokens: DataFrame
    token_metadata: DataFrame | None = None
    pool_contract_tokens: DataFrame | None = None


def routed_logs(logs: DataFrame) -> DataFrame:
    """O-24 + O-31 + O-32 + O-13..O-22: accepted logs with their standardised payload columns."""
    return normalize.normalize(normalize.route_supported(normalize.with_log_metadata(logs)))


def pool_events(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("kind") == "pool")


def factory_events(normalized: DataFrame) -> DataFrame:
    # The raw event_name test is a plain column predicate: on stored decoded
    # logs it reaches the Parquet scan (PushedFilters) and skips row groups.
    names = sorted({e for _, e, _, kind in dims.EVENT_DISPATCH if kind == "factory"})
    return normalized.filter(F.col("event_name").isin(names) & (F.col("kind") == "factory"))


def _stamp(df: DataFrame, created_at: Column | None) -> DataFrame:
    created = created_at if created_at is not None else F.current_timestamp()
    return (df.withColumn("created_at", created.cast("timestamp"))
              .withColumn("event_month", X.year_month("timestamp")))


def flatten_pool_events(enriched: DataFrame, created_at: Column | None = None) -> DataFrame:
    """O-26: stored row of a pool event. Missing name, gas, gas price and fee become ''."""
    rows = enriched.select(
        X.event_id("transaction_hash", "log_index", "event_type").alias("id"),
        F.col("p_protocol").alias("protocol"),
        F.col("p_version").alias("version"),
        "event_type",
        F.col("observed_at_ms").alias("timestamp"),
        "block_number", "transaction_hash", "log_index",
        F.col("p_pool_address").alias("pool_address"),
        F.col("p_token0_address").alias("token0_address"), F.col("p_token0_symbol").alias("token0_symbol"),
        F.col("p_token0_decimals").alias("token0_decimals"), X.or_empty("p_token0_name").alias("token0_name"),
        F.col("p_token1_address").alias("token1_address"), F.col("p_token1_symbol").alias("token1_symbol"),
        F.col("p_token1_decimals").alias("token1_decimals"), X.or_empty("p_token1_name").alias("token1_name"),
        F.col("event_data"),
        F.lit("").alias("gas_used"), F.lit("").alias("gas_price"), F.lit("").alias("fee"),
    )
    return _stamp(rows, created_at)


def flatten_factory_events(factory: DataFrame, created_at: Column | None = None) -> DataFrame:
    """O-27: stored row of a pool-creation log; token details are placeholders, log_index is 0."""
    rows = factory.select(
        X.factory_event_id("transaction_hash", "log_index", "event_type").alias("id"),
        "protocol", "version", "event_type",
        F.col("observed_at_ms").alias("timestamp"),
        "block_number", "transaction_hash",
        F.lit(0).cast("bigint").alias("log_index"),
        "pool_address",
        "token0_address", F.lit(dims.UNKNOWN_SYMBOL).alias("token0_symbol"),
        F.lit(dims.UNKNOWN_DECIMALS).cast("smallint").alias("token0_decimals"),
        F.lit(dims.UNKNOWN_NAME).alias("token0_name"),
        "token1_address", F.lit(dims.UNKNOWN_SYMBOL).alias("token1_symbol"),
        F.lit(dims.UNKNOWN_DECIMALS).cast("smallint").alias("token1_decimals"),
        F.lit(dims.UNKNOWN_NAME).alias("token1_name"),
        F.col("event_data"),
        F.lit("").alias("gas_used"), F.lit("").alias("gas_price"),
        X.or_empty("data_fee").alias("fee"),
    )
    return _stamp(rows, created_at)


def pool_dimension(normalized: DataFrame, d: Dimensions) -> DataFrame:
    return enrich.pool_dimension(d.seeds, factory_events(normalized), d.known_tokens, d.token_metadata, d.pool_contract_tokens)


def enriched_pool_events(normalized: DataFrame, d: Dimensions, discovery: bool = True,
                         pool_dim: DataFrame | None = None) -> DataFrame:
    dim = pool_dim if pool_dim is not None else pool_dimension(normalized, d)
    return enrich.attach_pools(pool_events(normalized), dim, discovery=discovery)


def flatten_all(joined: DataFrame, created_at: Column | None = None) -> DataFrame:
    """O-26 + O-27 + O-36 in one projection: pool rows and factory rows from one joined input."""
    fac = F.col("kind") == "factory"

    def pick(factory_value, pool_value):
        return F.when(fac, factory_value).otherwise(pool_value)

    unknown = {"symbol": F.lit(dims.UNKNOWN_SYMBOL), "decimals": F.lit(dims.UNKNOWN_DECIMALS).cast("smallint"),
               "name": F.lit(dims.UNKNOWN_NAME)}
    tokens = []
    for i in (0, 1):
        tokens.append(pick(F.col(f"token{i}_address"), F.col(f"p_token{i}_address")).alias(f"token{i}_address"))
        tokens.append(pick(unknown["symbol"], F.col(f"p_token{i}_symbol")).alias(f"token{i}_symbol"))
        tokens.append(pick(unknown["decimals"], F.col(f"p_token{i}_decimals")).alias(f"token{i}_decimals"))
        tokens.append(pick(unknown["name"], X.or_empty(f"p_token{i}_name")).alias(f"token{i}_name"))
    rows = joined.select(
        pick(X.factory_event_id("transaction_hash", "log_index", "event_type"),
             X.event_id("transaction_hash", "log_index", "event_type")).alias("id"),
        pick(F.col("protocol"), F.col("p_protocol")).alias("protocol"),
        pick(F.col("version"), F.col("p_version")).alias("version"),
        "event_type",
        F.col("observed_at_ms").alias("timestamp"),
        "block_number", "transaction_hash",
        pick(F.lit(0).cast("bigint"), F.col("log_index")).alias("log_index"),
        pick(F.col("pool_address"), F.col("p_pool_address")).alias("pool_address"),
        *tokens[:4], *tokens[4:],
        F.col("event_data"),
        F.lit("").alias("gas_used"), F.lit("").alias("gas_price"),
        pick(X.or_empty("data_fee"), F.lit("")).alias("fee"),
    )
    return _stamp(rows, created_at).select(*schemas.EVENT_COLUMNS)


def build_event_table(logs: DataFrame, d: Dimensions, created_at: Column | None = None,
                      discovery: bool = True, pool_dim: DataFrame | None = None,
                      write_dimension: bool = True) -> DataFrame:
    """O-36: pool events and factory events as one table with the stored schema.

    One scan of the logs: factory rows ride through the pool join unmatched.
    ``write_dimension=False`` when ``pool_dim`` already reads a written table.
    """
    normalized = routed_logs(logs)
    dim = pool_dim if pool_dim is not None else pool_dimension(normalized, d)
    joined = enrich.attach_pools(normalized, dim, discovery=discovery, passthrough=F.col("kind") == "factory",
                                 write_dimension=write_dimension)
    return flatten_all(joined, created_at)
