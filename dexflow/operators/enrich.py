"""Pool and token dimensions, discovery and event enrichment (O-33..O-42).

Scale notes:
* Token and pool resolution runs on the pool dimension (one row per pool),
  never per event; events meet the finished dimension in a single join.
* A pool is identified by (chain, lower-cased address): one address can hold
  different pools on two chains, whose block numbers do not compare.
* "First creation per pool" is an aggregate with ``min_by`` (a sort aggregate,
  since its buffer is a struct): partial aggregation runs map-side, so a pool created a million times costs one row
  per map task in the shuffle, not a million-row group.
* The event -> pool join is an equi join on the pool key plus a range
  condition; it is broadcast only after the materialised pool dimension has
  been counted under a row limit, and otherwise a sort-merge join that AQE
  splits when one pool holds a large share of the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources import dims
from ..plans.sizing import materialize_dimension

TOKEN_FIELDS = ["symbol", "decimals", "name"]


# -- O-35 token resolution --------------------------------------------------

def resolve_tokens(df: DataFrame, address_col: str, prefix: str, known_tokens: DataFrame,
                   token_metadata: DataFrame | None = None) -> DataFrame:
    """Attach ``{prefix}_symbol/_decimals/_name`` for the address in ``address_col``.

    Levels: fetched metadata (missing name -> 'Unknown') -> known-token table
    (missing name -> '') -> UNKNOWN / 18 / 'Unknown Token'. Joins are on the
    lower-cased address; the original text is kept. Runs on the pool
    dimension (one row per pool), never per event. No broadcast hint: the
    planner broadcasts a token table only when its size statistics are under
    the threshold (exact for the built-in constant list).
    """
    key = f"__{prefix}_key"
    known = known_tokens.select(X.lower_key("address").alias(key), F.col("symbol").alias("__k_symbol"),
                                F.col("decimals").alias("__k_decimals"), F.col("name").alias("__k_name"),
                                F.lit(True).alias("__k_hit"))
    out = df.withColumn(key, X.lower_key(address_col)).join(known, key, "left")
    k_hit = F.col("__k_hit").isNotNull()
    symbol = F.when(k_hit, F.col("__k_symbol"))
    decimals = F.when(k_hit, F.col("__k_decimals"))
    name = F.when(k_hit, F.coalesce(F.col("__k_name"), F.lit("")))
    extra = ["__k_symbol", "__k_decimals", "__k_name", "__k_hit"]
    if token_metadata is not None:
        fetched = token_metadata.select(X.lower_key("address").alias(key), F.col("symbol").alias("__m_symbol"),
                                        F.col("decimals").alias("__m_decimals"), F.col("name").alias("__m_name"),
                                        F.lit(True).alias("__m_hit"))
        out = out.join(fetched, key, "left")
        m_hit = F.col("__m_hit").isNotNull()
        symbol = F.when(m_hit, F.col("__m_symbol")).otherwise(symbol)
        decimals = F.when(m_hit, F.col("__m_decimals")).otherwise(decimals)
        name = F.when(m_hit, F.coalesce(F.col("__m_name"), F.lit(dims.MISSING_NAME))).otherwise(name)
        extra += ["__m_symbol", "__m_decimals", "__m_name", "__m_hit"]
    keep = [c for c in df.columns]
    return out.select(
        *keep,
        F.coalesce(symbol, F.lit(dims.UNKNOWN_SYMBOL)).alias(f"{prefix}_symbol"),
        F.coalesce(decimals, F.lit(dims.UNKNOWN_DECIMALS)).cast("smallint").alias(f"{prefix}_decimals"),
        F.coalesce(name, F.lit(dims.UNKNOWN_NAME)).alias(f"{prefix}_name"),
    )


def resolve_pool_tokens(pools: DataFrame, known_tokens: DataFrame, token_metadata: DataFrame | None = None) -> DataFrame:
    """O-35 for both sides of every pool."""
    out = resolve_tokens(pools, "token0_address", "token0", known_tokens, token_metadata)
    return resolve_tokens(out, "token1_address", "token1", known_tokens, token_metadata)


# -- O-38 / O-33 seed pools -------------------------------------------------

def pool_tokens(seeds: DataFrame, pool_contract_tokens: DataFrame | None = None) -> DataFrame:
    """O-38: token0/token1 of each seed pool; asked-from-contract values win over the fallback table.

    ``pool_contract_tokens`` has chain_id, pool_address, token0_address and token1_address, one row per pool: what the pool
    contracts answered. Either address may be null (no answer), then the seed's own counts.
    """
    if pool_contract_tokens is None:
        return seeds
    key = X.pool_key(dims.effective_chain(F.col("chain_id")), "pool_address").alias("__pk")
    fetched = pool_contract_tokens.select(key, F.col("token0_address").alias("__t0"), F.col("token1_address").alias("__t1"))
    out = seeds.withColumn("__pk", key).join(fetched, "__pk", "left")
    return (out.withColumn("token0_address", F.coalesce("__t0", "token0_address"))
               .withColumn("token1_address", F.coalesce("__t1", "token1_address"))
               .drop("__pk", "__t0", "__t1"))


def pools_resolved(seeds: DataFrame) -> DataFrame:
    """O-33: a pool with an unresolved token is not registered."""
    return seeds.filter(F.col("token0_address").isNotNull() & F.col("token1_address").isNotNull())


# -- O-39 / O-41 pool discovery -----------------------------------------------

POOL_COLUMNS = ["pool_key", "pool_address", "protocol", "chain_id", "token0_address", "token1_address",
                "fee", "tick_spacing", "is_seed", "created_block", "created_log_index", "created_tx",
                "created_at_ms"]


def chain_of(df: DataFrame) -> Column:
    """The routed chain of a log, or the effective chain of its ``chain_id``."""
    return F.col("chain") if "chain" in df.columns else dims.effective_chain(F.col("chain_id"))


def _factory_candidates(factory: DataFrame) -> DataFrame:
    # A creation log without a pool address cannot register a pool.
    return factory.filter(F.col("pool_address").isNotNull()).select(
        X.pool_key(chain_of(factory), "pool_address").alias("pool_key"), "pool_address", "protocol",
        chain_of(factory).alias("chain_id"),
        "token0_address", "token1_address", "fee", "tick_spacing",
        F.lit(False).alias("is_seed"),
        F.col("block_number").alias("created_block"), F.col("log_index").alias("created_log_index"),
        F.col("transaction_hash").alias("created_tx"), F.col("observed_at_ms").alias("created_at_ms"))


def _seed_candidates(seeds: DataFrame) -> DataFrame:
    return pools_resolved(seeds).select(
        X.pool_key(dims.effective_chain(F.col("chain_id")), "pool_address").alias("pool_key"),
        "pool_address", "protocol", F.col("chain_id").cast("int"),
        "token0_address", "token1_address",
        # Seed V3 pools carry no fee or tick spacing.
        F.lit(None).cast("int").alias("fee"), F.lit(None).cast("int").alias("tick_spacing"),
        F.lit(True).alias("is_seed"),
        F.lit(None).cast("bigint").alias("created_block"), F.lit(None).cast("bigint").alias("created_log_index"),
        F.lit(None).cast("string").alias("created_tx"), F.lit(None).cast("bigint").alias("created_at_ms"))


#: The registration that counts: a seed, else the earliest creation.
def _registration_order() -> list:
    return [F.when(F.col("is_seed"), 0).otherwise(1), F.col("created_block"), F.col("created_log_index"), F.col("created_tx")]


def first_registrations(pools: DataFrame) -> DataFrame:
    """One row per pool of a registry that may hold several: a seed, else the earliest creation."""
    return _first_per_pool(pools, _registration_order())


def new_registrations(first: DataFrame, current: DataFrame) -> DataFrame:
    """Pools of ``first`` that ``current`` does not know, or knows (not as a seed) from a later creation."""
    at = F.struct("created_block", "created_log_index")
    known = current.select(F.col("pool_key"), F.col("is_seed").alias("__seed"), at.alias("__at"))
    joined = first.join(known, "pool_key", "left")
    return joined.filter(F.col("__seed").isNull() | (~F.col("__seed") & (at < F.col("__at")))).select(*POOL_COLUMNS)


def _first_per_pool(candidates: DataFrame, order: list) -> DataFrame:
    rest = [c for c in POOL_COLUMNS if c != "pool_key"]
    picked = candidates.groupBy("pool_key").agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("p"))
    return picked.select("pool_key", *[F.col(f"p.{c}").alias(c) for c in rest])


def first_pools(factory: DataFrame) -> DataFrame:
    """O-39: one registration per pool, the earliest creation by (block, log_index, tx)."""
    return _first_per_pool(_factory_candidates(factory),
                           [F.col("created_block"), F.col("created_log_index"), F.col("created_tx")])


def known_pools(seeds: DataFrame, factory: DataFrame) -> DataFrame:
    """O-41: seed pools plus discovered pools; a seed wins over any creation event.

    One aggregate over the union: the seed rows sort first, then the earliest
    creation. Seeds with an unresolved token are not registered (O-33), so a
    later creation event can still register that pool.
    """
    cands = _seed_candidates(seeds).unionByName(_factory_candidates(factory))
    return _first_per_pool(cands, _registration_order())


def seed_pool_dimension(seeds: DataFrame, known_tokens: DataFrame,
                        token_metadata: DataFrame | None = None) -> DataFrame:
    """Resolved seed pools only (the static watch list), with version and token details."""
    pools = _seed_candidates(seeds).withColumn("version", dims.version_of(F.col("protocol")))
    return resolve_pool_tokens(pools, known_tokens, token_metadata)


def pool_dimension(seeds: DataFrame, factory: DataFrame, known_tokens: DataFrame,
                   token_metadata: DataFrame | None = None, pool_contract_tokens: DataFrame | None = None) -> DataFrame:
    """Known pools with version and resolved token details (one row per pool)."""
    pools = known_pools(pool_tokens(seeds, pool_contract_tokens), factory).withColumn("version", dims.version_of(F.col("protocol")))
    return resolve_pool_tokens(pools, known_tokens, token_metadata)


# -- O-34 / O-40 event enrichment ---------------------------------------------

ENRICHED_POOL_COLUMNS = ["pool_key", "protocol", "version", "pool_address", "is_seed", "created_block",
                         "created_log_index", "token0_address", "token0_symbol", "token0_decimals", "token0_name",
                         "token1_address", "token1_symbol", "token1_decimals", "token1_name"]


def _matches(ev: DataFrame, dim: DataFrame, discovery: bool = True) -> Column:
    """A log (with ``__pk``) belongs to a pool of ``dim`` (columns ``p_``) and, for a discovered pool, follows its creation."""
    # A log of another protocol than the pool's cannot come from that pool's handlers.
    cond = (ev["__pk"] == dim["p_pool_key"]) & (ev["protocol"] == dim["p_protocol"])
    if discovery:
        after = (F.struct(ev["block_number"], ev["log_index"])
                 > F.struct(dim["p_created_block"], dim["p_created_log_index"]))
        cond = cond & (dim["p_is_seed"] | after)
    return cond


def split_by_pools(pool_events: DataFrame, pools: DataFrame, matched: bool) -> DataFrame:
    """The pool logs that ``attach_pools`` keeps with ``pools`` (``matched``) or drops, unchanged; those without an address in neither."""
    dim = pools.select(*[F.col(c).alias(f"p_{c}") for c in
                         ("pool_key", "protocol", "is_seed", "created_block", "created_log_index")])
    ev = pool_events.filter(F.col("pool_address").isNotNull())
    ev = ev.withColumn("__pk", X.pool_key(chain_of(pool_events), "pool_address"))
    return ev.join(dim, _matches(ev, dim), "left_semi" if matched else "left_anti").drop("__pk")


def attach_pools(pool_events: DataFrame, pool_dim: DataFrame, discovery: bool = True,
                 max_broadcast_rows: int | None = None, passthrough: Column | None = None,
                 write_dimension: bool = True, mark_unmatched: str | None = None) -> DataFrame:
    """Every pool event carries its pool's protocol, version and tokens (inner join).

    With ``discovery`` a discovered pool's events count only after its
    creation log: ``(block, log_index) > (created_block, created_log_index)``;
    seed pools count from the start. Unknown pools are dropped.

    ``passthrough`` marks rows that need no pool (factory logs): they are kept
    unmatched by one left join, so a single scan of the source feeds both
    kinds of rows (no union of two scans). ``mark_unmatched`` names a column that
    says which rows found no pool though they need one, and keeps them.
    """
    dim = pool_dim.select(*[F.col(c).alias(f"p_{c}") for c in ENRICHED_POOL_COLUMNS])
    dim = materialize_dimension(dim, max_broadcast_rows, write=write_dimension)
    ev = pool_events.withColumn("__pk", X.pool_key(chain_of(pool_events), "pool_address"))
    cond = _matches(ev, dim, discovery)
    if passthrough is None:
        joined = ev.join(dim, cond, "inner")
    else:
        ev = ev.withColumn("__pass", passthrough)
        joined = ev.join(dim, cond & ~ev["__pass"], "left")
        found = F.col("__pass") | F.col("p_pool_key").isNotNull()
        joined = (joined.filter(found) if mark_unmatched is None else joined.withColumn(mark_unmatched, ~found)).drop("__pass")
    return joined.drop("__pk", "p_pool_key", "p_is_seed", "p_created_block", "p_created_log_index")
