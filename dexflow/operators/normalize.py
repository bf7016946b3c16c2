"""Routing, dispatch and normalisation of decoded logs (O-13..O-33).

Every function is ``DataFrame -> DataFrame`` for ``.transform()``: one
narrow pass with ``when`` expressions, no scan per event type, no shuffle, so
it runs unchanged inside a streaming micro-batch.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources import dims

# Payload fields in JSON key order; NULL fields are left out of the JSON text.
PAYLOAD_FIELDS = dims.PAYLOAD_KEYS


# -- O-24 metadata fallback -------------------------------------------------

def with_log_metadata(logs: DataFrame, tx_cols=("transaction_hash",), index_cols=("log_index",),
                      block_cols=("block_number",)) -> DataFrame:
    """First present source field for tx hash, log index and block; NULL-only fallbacks.

    A missing hash becomes a deterministic surrogate, a missing index 0 and a
    missing block 0, so replays produce the same ids.
    """
    tx = X.first_present(*tx_cols)
    idx = X.first_present(*index_cols, default=F.lit(0).cast("bigint"))
    blk = X.first_present(*block_cols, default=F.lit(0).cast("bigint"))
    surrogate = X.surrogate_tx_hash("chain_id", "pool_address", "block_number", "log_index", "observed_at_ms")
    return (logs.withColumn("transaction_hash", F.coalesce(tx, surrogate))
                .withColumn("log_index", idx.cast("bigint"))
                .withColumn("block_number", blk.cast("bigint")))


# -- O-31 routing, O-32 dispatch ----------------------------------------------

def with_route(logs: DataFrame) -> DataFrame:
    """Add ``chain`` (unknown chains fall back to Ethereum), ``event_type``, ``kind`` and ``accepted``.

    If the logs say which contract emitted them (``emitter``), a creation log counts only from the factory
    of its chain and protocol: any contract can emit one.
    """
    chain = dims.effective_chain(F.col("chain_id"))
    event_type = dims.dispatch(F.col("protocol"), F.col("event_name"))
    routed = logs.select("*", chain.alias("chain"), event_type.alias("event_type"))
    accepted = dims.is_supported(F.col("chain"), F.col("protocol")) & F.col("event_type").isNotNull()
    return routed.select("*", dims.kind_of(F.col("event_type")).alias("kind"),
                         (accepted & ~foreign_creation(routed)).alias("accepted"))


def foreign_creation(routed: DataFrame) -> Column:
    """Whether a log is a creation log that its factory did not emit."""
    if "emitter" not in routed.columns:
        return F.lit(False)
    factory = dims.factory_contract(F.col("chain"), F.col("protocol"))
    own = F.coalesce(X.lower_key("emitter") == factory, F.lit(False))
    return F.coalesce(dims.kind_of(F.col("event_type")) == "factory", F.lit(False)) & ~own


def route_supported(logs: DataFrame) -> DataFrame:
    """Logs of a supported (chain, protocol) with a handled event name."""
    return with_route(logs).filter(F.col("accepted")).drop("accepted")


def route_rejected(logs: DataFrame) -> DataFrame:
    """What is left out: unsupported (chain, protocol), unhandled event (Collect, Flash, ...), creation by a foreign contract."""
    routed = with_route(logs).filter(~F.col("accepted"))
    reason = (F.when(~dims.is_supported(F.col("chain"), F.col("protocol")), F.lit("unsupported_protocol"))
               .when(F.col("event_type").isNull(), F.lit("unhandled_event")).otherwise(F.lit("foreign_emitter")))
    return routed.withColumn("reject_reason", reason).drop("accepted")


def version_column(protocol: str | Column = "protocol") -> Column:
    return dims.version_of(X.col(protocol))


# -- O-13..O-22 payload -----------------------------------------------------

def payload_columns(event_type: Column, version: Column) -> dict[str, Column]:
    """Per-field expressions of the standardised payload for pool and factory logs."""
    v3 = version == "v3"
    swap, mint, burn = event_type == "swap", event_type == "mint", event_type == "burn"
    liq = mint | burn
    factory = event_type.isin(*dims.FACTORY_EVENT_TYPES)
    s = F.col
    return {
        "type": event_type,
        # V3 burn has only an owner: the sender is the owner.
        "sender": F.when(swap, s("sender")).when(liq & v3 & burn, s("owner")).when(liq, s("sender")),
        "recipient": F.when(swap, s("recipient")),
        # V2 mint/burn: owner is the sender.
        "owner": F.when(liq & v3, s("owner")).when(liq, s("sender")),
        "amount0In": F.when(swap & v3, X.signed_in("amount0")).when(swap, s("amount0_in")),
        "amount1In": F.when(swap & v3, X.signed_in("amount1")).when(swap, s("amount1_in")),
        "amount0Out": F.when(swap & v3, X.signed_out("amount0")).when(swap, s("amount0_out")),
        "amount1Out": F.when(swap & v3, X.signed_out("amount1")).when(swap, s("amount1_out")),
        "amount0": F.when(liq, s("amount0")),
        "amount1": F.when(liq, s("amount1")),
        # V2 mint/burn carry no liquidity amount.
        "liquidity": F.when(liq & v3, s("liquidity")).when(liq, F.lit("0")),
        "reserve0": F.when(event_type == "sync", s("reserve0")),
        "reserve1": F.when(event_type == "sync", s("reserve1")),
        "sqrtPriceX96": F.when((swap & v3) | (event_type == "initialize"), s("sqrt_price_x96")),
        "tick": F.when((swap & v3) | (event_type == "initialize"), X.json_text("tick")),
        "tickLower": F.when(liq & v3, X.json_text("tick_lower")),
        "tickUpper": F.when(liq & v3, X.json_text("tick_upper")),
        "fee": F.when(factory, X.json_text("fee")),
        "tickSpacing": F.when(factory, X.json_text("tick_spacing")),
    }


def normalize(routed: DataFrame) -> DataFrame:
    """Standardised payload columns for routed logs (pool and factory), one pass."""
    version = version_column("protocol")
    cols = payload_columns(F.col("event_type"), version)
    keep = ["chain", "chain_id", "protocol", "event_name", "event_type", "kind", "pool_address", "transaction_hash",
            "block_number", "log_index", "observed_at_ms", "token0_address", "token1_address", "fee", "tick_spacing"]
    out = routed.select(*keep, version.alias("version"),
                        *[cols[name].alias(f"data_{name}") for name in PAYLOAD_FIELDS if name != "type"])
    # The JSON payload depends only on the log itself: built here, before any
    # join, so only this one string (not the payload columns) crosses the join.
    return out.select("*", normalized_event_data().alias("event_data"))


def normalized_event_data() -> Column:
    """``event_data`` from the ``data_*`` columns produced by :func:`normalize`."""
    fields = [F.col("event_type").alias("type")] + [F.col(f"data_{n}").alias(n) for n in PAYLOAD_FIELDS[1:]]
    return F.to_json(F.struct(*fields))


# -- O-28 payload reader ----------------------------------------------------

def _fill(template: str, values: dict[str, Column]) -> Column:
    """A text template with {name} slots as one concat of literals and columns."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            if piece:
                parts.append(F.lit(piece))
        else:
            parts.append(values[piece])
    return F.concat(*parts)


def event_summary(event_type: str | Column = "event_type", data: str | Column = "event_data",
                  symbol0: str | Column = "token0_symbol", symbol1: str | Column = "token1_symbol") -> Column:
    """One-line text of a stored event, read back from its JSON payload (a missing value prints 'undefined')."""
    t, d = X.col(event_type), X.col(data)
    slots: dict[str, Column] = {"symbol0": X.col(symbol0), "symbol1": X.col(symbol1)}
    for key in PAYLOAD_FIELDS:
        slots[key] = F.coalesce(F.get_json_object(d, f"$.{key}"), F.lit("undefined"))
    expr = None
    for kind, template in dims.SUMMARY_FORMATS.items():
        text = _fill(template, slots)
        expr = F.when(t == kind, text) if expr is None else expr.when(t == kind, text)
    return expr
