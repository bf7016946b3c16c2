"""More registered queries: feeds derived from ``events`` that reach rules FX2 alone does not, and tables stored by the engine.

As in ``catalog``, each is a Spark builder and its DuckDB oracle, and every one starts from the driver's ``events``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import exprs as X
from ..operators import checks, enrich, normalize, reports
from ..session import scratch_path
from ..sources import dims, fixtures, partials, store
from . import catalog as C
from . import events as E

_LOCK = threading.RLock()


def once(ctx: C.Context, name: str, build: Callable[[], object]):
    """What ``build`` gives, once per context."""
    with _LOCK:
        kept = ctx.__dict__.setdefault("_derived", {})
        if name not in kept:
            kept[name] = build()
        return kept[name]


def table(ctx: C.Context, name: str, logs: DataFrame, **options) -> str:
    """The folder of the event table built from ``logs``, written once per context."""
    def write():
        path = scratch_path(ctx.spark, f"dexflow-{name}")
        store.write_events(E.build_event_table(logs, ctx.dims), path, **options)
        return path
    return once(ctx, name, write)


def months_path(ctx: C.Context) -> str:
    return table(ctx, "months", fixtures.spread_over_months(ctx.logs))


def over_months(statement: str) -> str:
    """The statement over FX2 spread over several months."""
    return statement.replace("CAST(ms AS BIGINT) AS observed_at_ms",
                             f"CAST(ms - (18000000 + ms // 12000 - 142000000) % 4 * {fixtures.MONTH_MS} AS BIGINT) AS observed_at_ms")


def with_feed(select: str, feed: str, extra: str = "") -> str:
    """A statement whose decoded logs are ``feed``, a select over ``fx2``, the plain ones."""
    return O.with_base(select, extra).replace("\ndecoded_logs AS (\n", "\nfx2 AS (\n", 1).replace("\npool_seed AS (", f"\ndecoded_logs AS ({feed}),\npool_seed AS (", 1)


# -- newest events of the stored table (O-30, O-53, O-56) ---------------------

def q_stored_recent_events(spark, sf_dir):
    """O-53: the ten newest of a table of several months, from the newest month."""
    top = store.newest_events(spark, months_path(C.context(spark, sf_dir)), 10)
    return top.select(*reports.RECENT_COLUMNS, X.seconds_time("timestamp").alias("event_time"))


def q_stored_feed20(spark, sf_dir):
    return reports.feed_last(store.newest_events(spark, months_path(C.context(spark, sf_dir)), 20), 20)


def q_stored_protocol_newest(spark, sf_dir):
    """O-30: the newest 2,000 events of a protocol, more than a month may hold."""
    top = store.newest_events(spark, months_path(C.context(spark, sf_dir)), 2000, F.col("protocol") == C.FEED_PROTOCOL)
    return top.select("id", "protocol", "timestamp")


# -- exact distincts from partials (O-44, O-45) ---------------------------------

PARTIAL_RANGE_MS = (1_701_388_800_000, 1_704_844_800_000)  # 2023-12-01 to 2024-01-10, UTC


def partials_path(ctx: C.Context) -> str:
    def write():
        path = scratch_path(ctx.spark, "dexflow-partials")
        partials.write_partials(store.read_events(ctx.spark, months_path(ctx)), path)
        return path
    return once(ctx, "partials", write)


def q_partial_event_stats(spark, sf_dir):
    return partials.event_stats(spark, partials_path(C.context(spark, sf_dir)))


def q_partial_stats_range(spark, sf_dir):
    return partials.event_stats(spark, partials_path(C.context(spark, sf_dir)), *PARTIAL_RANGE_MS)


def q_partial_hourly_rollup(spark, sf_dir):
    return partials.hourly_rollup(spark, partials_path(C.context(spark, sf_dir)))


# -- stored copies (O-43, O-48..O-50) -----------------------------------------------

def stored_copies(ctx: C.Context) -> dict[str, DataFrame]:
    """Three stored copies: the table, the per-chain builds appended one by one, and the compacted months."""
    def write():
        months, chains, done = months_path(ctx), scratch_path(ctx.spark, "dexflow-chains"), scratch_path(ctx.spark, "dexflow-compacted")
        logs, chain = fixtures.spread_over_months(ctx.logs), dims.effective_chain(F.col("chain_id"))
        for c in (dims.ETHEREUM_CHAIN_ID, dims.BSC_CHAIN_ID):
            store.write_events(E.build_event_table(logs.filter(chain == c), ctx.dims), chains)
        for month in sorted(r[0] for r in store.read_events(ctx.spark, months, ["event_month"]).distinct().collect()):
            store.compact_month(ctx.spark, months, month, done)
        return {"primary": months, "by_chain": chains, "compacted": done}
    return {k: store.read_events(ctx.spark, p) for k, p in once(ctx, "copies", write).items()}


def damaged_path(ctx: C.Context) -> str:
    """A stored copy with faults: a changed payload, a missing row, rows that stand twice in pairs."""
    def write():
        path = scratch_path(ctx.spark, "dexflow-damaged")
        end = F.substring("transaction_hash", -2, 2)
        rows = store.read_events(ctx.spark, months_path(ctx)).filter(end != "78")
        rows = rows.withColumn("fee", F.when(end == "77", "x").otherwise(F.col("fee")))
        store.write_events(rows.unionByName(rows.filter(end == "79")), path)
        return path
    return once(ctx, "damaged", write)


def q_stored_copy_counts(spark, sf_dir):
    return checks.copy_counts(stored_copies(C.context(spark, sf_dir)))


def q_stored_copy_verdict(spark, sf_dir):
    return checks.copy_verdict(stored_copies(C.context(spark, sf_dir)))


def _differences(ctx: C.Context) -> DataFrame:
    copies = stored_copies(ctx) | {"damaged": store.read_events(ctx.spark, damaged_path(ctx))}
    return checks.copy_differences(copies, "primary")


def q_copy_differences(spark, sf_dir):
    """O-50: the partitions of each stored copy that are not those of the table."""
    return _differences(C.context(spark, sf_dir))


def q_differing_ids(spark, sf_dir):
    """O-50: the rows behind the differences, from the differing partitions alone."""
    ctx = C.context(spark, sf_dir)
    found = _differences(ctx).filter("copy = 'damaged'")
    return checks.differing_ids(store.read_events(spark, damaged_path(ctx)), store.read_events(spark, months_path(ctx)), found)


def q_written_integrity(spark, sf_dir):
    """O-43, O-48: what the writer saw while it wrote the table."""
    ctx = C.context(spark, sf_dir)
    seen = once(ctx, "observed", lambda: store.write_events_observed(ctx.events, scratch_path(spark, "dexflow-observed")))
    return spark.createDataFrame([tuple(seen.values())], ", ".join(f"{k} bigint" for k in seen))


def q_created_at_check(spark, sf_dir):
    """O-58d: every stored row has one insertion time, taken while the table was written."""
    rows = C.context(spark, sf_dir).stored(["created_at"])
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("created_at")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count("created_at").alias("stamped"), (F.count_distinct("created_at") == 1).alias("one_time"),
                    (F.min(age) >= 0).alias("not_ahead"))


def q_compacted_events(spark, sf_dir):
    """O-60: a table of two batches in which a quarter of the logs came twice, in another month the second time; read compacted."""
    ctx = C.context(spark, sf_dir)

    def write():
        path, done = scratch_path(spark, "dexflow-batches"), scratch_path(spark, "dexflow-batches-done")
        logs = fixtures.spread_over_months(ctx.logs)
        later = F.col("observed_at_ms") + F.lit(fixtures.MONTH_MS)
        again = logs.filter(F.col("block_number") % 4 == 3).withColumn("observed_at_ms", later)
        for batch, part in enumerate((logs, again)):
            store.write_events(E.build_event_table(part, ctx.dims, pool_dim=E.pool_dimension(E.routed_logs(logs), ctx.dims)), path, batch_id=batch)
        months = sorted(r[0] for r in store.read_events(spark, path, ["event_month"]).distinct().collect())
        for month in months[:-1]:  # the newest month is open
            store.compact_month(spark, path, month, done)
        return path, done
    path, done = once(ctx, "compacted", write)
    return store.read_compacted(spark, path, done, ["id", "timestamp", "event_month"])


# -- feeds that reach the other rules -------------------------------------------

def q_emitter_known_pools(spark, sf_dir):
    """O-02: pools registered by creation logs of their factory alone."""
    ctx = C.context(spark, sf_dir)
    dim = E.pool_dimension(E.routed_logs(fixtures.with_emitters(ctx.logs)), ctx.dims)
    return dim.select(*C.KNOWN_POOL_COLUMNS)


def q_emitter_events(spark, sf_dir):
    ctx = C.context(spark, sf_dir)
    return E.build_event_table(fixtures.with_emitters(ctx.logs), ctx.dims).select(*C.SCAN_COLUMNS)


def q_emitter_rejected(spark, sf_dir):
    ctx = C.context(spark, sf_dir)
    rejected = normalize.route_rejected(normalize.with_log_metadata(fixtures.with_emitters(ctx.logs)))
    return rejected.groupBy("chain", "protocol", "event_name", "emitter", "reject_reason").agg(F.count(F.lit(1)).alias("logs"))


def q_factory_contract_logs(spark, sf_dir):
    """O-03: the factory contracts with the creation logs that each emitted, none for some."""
    logs = fixtures.with_emitters(C.context(spark, sf_dir).logs)
    made = logs.filter(F.col("event_name").isin("PairCreated", "PoolCreated")).groupBy(
        dims.effective_chain(F.col("chain_id")).alias("chain_id"), "protocol", X.lower_key("emitter").alias("key")).agg(F.count(F.lit(1)).alias("logs"))
    contracts = dims.contract_addresses(spark).withColumn("key", X.lower_key("factory"))
    return contracts.join(made, ["chain_id", "protocol", "key"], "left").select("chain_id", "protocol", "factory", F.coalesce("logs", F.lit(0)).alias("logs"))


def q_dispatch_coverage(spark, sf_dir):
    """O-03, O-32: the accepted events of each protocol, with the logs of each."""
    logs = C.context(spark, sf_dir).logs.groupBy("protocol", "event_name").agg(F.count(F.lit(1)).alias("logs"))
    return dims.dispatch_table(spark).join(logs, ["protocol", "event_name"], "left").select(
        "protocol", "event_name", "event_type", "kind", F.coalesce("logs", F.lit(0)).alias("logs"))


def _mainnet(ctx: C.Context) -> E.Dimensions:
    return E.Dimensions(dims.seed_pools(ctx.spark), dims.known_tokens(ctx.spark))


MAINNET_COLUMNS = ["id", "protocol", "event_type", "pool_address", "token0_address", "token0_symbol", "token0_decimals", "token0_name",
                   "token1_address", "token1_symbol", "token1_decimals", "token1_name"]


def q_mainnet_events(spark, sf_dir):
    """O-03: the table over the watched pools and known tokens."""
    ctx = C.context(spark, sf_dir)
    return E.build_event_table(fixtures.mainnet(ctx.logs), _mainnet(ctx)).select(*MAINNET_COLUMNS)


def q_answered_pools(spark, sf_dir):
    """O-38: seed pools whose tokens the pool contract gave, with the seed's own where it did not."""
    ctx = C.context(spark, sf_dir)
    d = E.Dimensions(ctx.dims.seeds, ctx.dims.known_tokens, pool_contract_tokens=fixtures.contract_answers(ctx.logs))
    return E.pool_dimension(ctx.normalized, d).select(*C.DIM_POOL_COLUMNS)


def q_missing_metadata_events(spark, sf_dir):
    """O-24: the table over logs without hash, index or block."""
    ctx = C.context(spark, sf_dir)
    return E.build_event_table(fixtures.without_metadata(ctx.logs), ctx.dims).select(
        "id", "protocol", "event_type", "pool_address", "block_number", "log_index", "transaction_hash")


def q_rejected_routes(spark, sf_dir):
    """O-31: what no route takes, by reason."""
    rejected = normalize.route_rejected(normalize.with_log_metadata(fixtures.mixed_routing(C.context(spark, sf_dir).logs)))
    return rejected.groupBy("chain", "protocol", "event_name", "reject_reason").agg(F.count(F.lit(1)).alias("logs"))


def q_mixed_route_events(spark, sf_dir):
    ctx = C.context(spark, sf_dir)
    return E.build_event_table(fixtures.mixed_routing(ctx.logs), ctx.dims).select(*C.SCAN_COLUMNS)


def q_redelivered_duplicate_ids(spark, sf_dir):
    """O-51: the ids that stand twice when every fourth block is delivered twice."""
    ctx = C.context(spark, sf_dir)
    return checks.duplicate_ids(E.build_event_table(fixtures.delivered_again(ctx.logs), ctx.dims))


def q_redelivered_uniqueness(spark, sf_dir):
    ctx = C.context(spark, sf_dir)
    return checks.id_uniqueness(E.build_event_table(fixtures.delivered_again(ctx.logs), ctx.dims))


# -- streaming: distincts, handlers ------------------------------------------------

def q_stream_distinct_check(spark, sf_dir):
    """O-62: the sketches' distinct counts lie within their stated error of the exact ones."""
    from ..streaming.ingest import check_distincts
    job = C.context(spark, sf_dir).stream_job
    return check_distincts(job.read_rollup(), job.read_events())


def _handled(ctx: C.Context) -> str:
    """A stream with two handlers that append what they get, and its last batch run again."""
    def run():
        from ..streaming.replay import replay_last_batch, run_file_stream
        root = scratch_path(ctx.spark, "dexflow-handled")

        def append_events(rows, batch_id):
            rows.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(f"{root}/events")

        def append_pools(rows, batch_id):
            rows.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(f"{root}/pools")

        job = run_file_stream(ctx.spark, ctx.logs, ctx.dims, root=root, job_options={"on_event": [append_events], "on_factory": [append_pools]})
        replay_last_batch(job, f"{root}/source")
        return root
    return once(ctx, "handled", run)


def q_handled_events(spark, sf_dir):
    """O-64: what an ``on_event`` handler got, although the last batch ran twice."""
    return spark.read.parquet(f"{_handled(C.context(spark, sf_dir))}/events").select(*C.STORED_COLUMNS)


def q_handled_factories(spark, sf_dir):
    """O-64: what an ``on_factory`` handler got."""
    return spark.read.parquet(f"{_handled(C.context(spark, sf_dir))}/pools").select(*C.STORED_COLUMNS)


# ---------------------------------------------------------------------------
# Oracle SQL.
# ---------------------------------------------------------------------------

_STATS = (f"SELECT protocol, event_type, {C._DISTINCT3}, {O.ms_to_seconds('min(timestamp)')} AS first_event, "
          f"{O.ms_to_seconds('max(timestamp)')} AS last_event FROM protocol_events")
_COPY3 = "copies AS (SELECT unnest(['primary', 'by_chain', 'compacted']) AS copy, id, protocol, timestamp FROM protocol_events)"
_DAMAGED = f"""marked AS (SELECT {C._STORED}, substr(md5(id), 1, 1) AS bucket, right(transaction_hash, 2) AS e FROM protocol_events),
counted AS (SELECT *, CASE e WHEN '78' THEN 0 WHEN '79' THEN 2 ELSE 1 END AS n, e = '77' AND fee <> 'x' AS changed FROM marked)"""
_CREATION = "event_name IN ('PairCreated', 'PoolCreated')"
# The factories, written out here so that a wrong entry of the library's table shows.
_FACTORIES = """(VALUES (1, 'uniswap-v2', '0x5C69bEe701ef814a2B6a3EDD4B1652CB9cc5aA6f'), (1, 'uniswap-v3', '0x1F98431c8aD98523631AE4a59f267346ea31F984'),
  (1, 'pancakeswap-v2', '0xcA143Ce0Fe65960e6Aa4D42C8d3cE161c2B6604f'), (56, 'pancakeswap-v2', '0xcA143Ce0Fe65960e6Aa4D42C8d3cE161c2B6604f'))
  f(chain_id, protocol, factory)"""
_EMITTED = f"""SELECT x.*, CASE WHEN NOT {_CREATION} THEN pool_address WHEN block_number % 3 = 0 THEN '{fixtures.FOREIGN}'
  WHEN block_number % 7 = 1 THEN NULL ELSE f.factory END AS emitter FROM fx2 x LEFT JOIN {_FACTORIES} USING (chain_id, protocol)"""
_OWN_ONLY = f"SELECT * EXCLUDE (emitter) FROM ({_EMITTED}) WHERE NOT {_CREATION} OR emitter <> '{fixtures.FOREIGN}'"
_MIXED = """SELECT * REPLACE (CASE WHEN block_number % 6 = 0 THEN 'Collect' ELSE event_name END AS event_name,
  CASE WHEN block_number % 6 = 1 THEN 'sushiswap' ELSE protocol END AS protocol,
  CAST(CASE block_number % 6 WHEN 2 THEN 56 WHEN 3 THEN 137 WHEN 4 THEN NULL ELSE chain_id END AS INT) AS chain_id) FROM fx2"""
_HOLES = """SELECT * REPLACE (CASE WHEN observed_at_ms % 5 <> 0 THEN transaction_hash END AS transaction_hash,
  CASE WHEN observed_at_ms % 7 <> 0 THEN log_index END AS log_index,
  CASE WHEN observed_at_ms % 11 <> 0 THEN block_number END AS block_number) FROM fx2"""
_TWICE = "SELECT * FROM fx2 UNION ALL SELECT * FROM fx2 WHERE block_number % 4 = 0"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _on_mainnet(select: str) -> str:
    feed = f"""SELECT x.* REPLACE (p.a AS pool_address, lower(k0.a) AS token0_address, lower(k1.a) AS token1_address) FROM fx2 x
      LEFT JOIN (VALUES {_values((i, s[1]) for i, s in enumerate(dims.SEED_POOLS))}) p(i, a) ON p.i = right(x.pool_address, 2)::INT
      LEFT JOIN (VALUES {_values((i + 100, t[0]) for i, t in enumerate(dims.KNOWN_TOKENS))}) k0(i, a) ON k0.i = right(x.token0_address, 3)::INT
      LEFT JOIN (VALUES {_values((i + 100, t[0]) for i, t in enumerate(dims.KNOWN_TOKENS))}) k1(i, a) ON k1.i = right(x.token1_address, 3)::INT"""
    base = with_feed(select, feed)
    a, b, c = base.index("\npool_seed AS ("), base.index("\ntoken_known AS ("), base.index("\nrouted AS (")
    seeds = f"""
pool_seed AS (SELECT protocol, CAST(CASE WHEN protocol = 'pancakeswap-v2' THEN 56 ELSE 1 END AS INT) AS chain_id, pool_address, token0_address, token1_address
  FROM (VALUES {_values(dims.SEED_POOLS)}) v(protocol, pool_address, token0_address, token1_address)),
token_known AS (SELECT address, symbol, decimals::SMALLINT AS decimals, name FROM (VALUES {_values(dims.KNOWN_TOKENS)}) v(address, symbol, decimals, name)),"""
    assert a < b < c
    return base[:a] + seeds + base[c:]


def _answered(select: str) -> str:
    """The seeds' tokens are those of the first creation log of odd pools, where it has them."""
    base = O.with_base(select)
    answers = """answers AS (SELECT chain_id, pool_address, CASE WHEN pool_address LIKE '%05' THEN NULL ELSE token0_address END AS t0, token1_address AS t1
  FROM (SELECT *, row_number() OVER (PARTITION BY chain_id, pool_address ORDER BY block_number, log_index, transaction_hash) AS rn
        FROM decoded_logs WHERE token0_address IS NOT NULL AND right(pool_address, 1)::INT % 2 = 1) WHERE rn = 1),
asked AS (SELECT s.* REPLACE (coalesce(t0, token0_address) AS token0_address, coalesce(t1, token1_address) AS token1_address)
  FROM pool_seed s LEFT JOIN answers USING (chain_id, pool_address)),
routed AS ("""
    return base.replace("routed AS (", answers, 1).replace("FROM pool_seed WHERE", "FROM asked WHERE", 1)


ORACLE: dict[str, str] = {
    "stored_recent_events": over_months(C.ORACLE["recent_events"]),
    "stored_feed20": over_months(C.ORACLE["feed_last20"]),
    "stored_protocol_newest": over_months(O.with_base(
        f"SELECT id, protocol, timestamp FROM protocol_events WHERE protocol = '{C.FEED_PROTOCOL}' ORDER BY {C._NEWEST} LIMIT 2000")),
    "partial_event_stats": over_months(O.with_base(f"{_STATS} GROUP BY protocol, event_type")),
    "partial_stats_range": over_months(O.with_base(
        f"{_STATS} WHERE timestamp >= {PARTIAL_RANGE_MS[0]} AND timestamp < {PARTIAL_RANGE_MS[1]} GROUP BY protocol, event_type")),
    "partial_hourly_rollup": over_months(C.ORACLE["hourly_rollup"]),
    "stored_copy_counts": over_months(O.with_base(f"SELECT copy, {C._SUMMARY_AGGS} FROM copies GROUP BY copy", _COPY3)),
    "stored_copy_verdict": over_months(O.with_base(
        "SELECT 3::BIGINT AS copies, TRUE AS consistent, 3 * count(*) AS total_rows, count(*) AS min_rows, count(*) AS max_rows, TRUE AS same_ids "
        "FROM protocol_events")),
    "copy_differences": over_months(O.with_base(
        "SELECT 'damaged' AS copy, event_month, bucket, CAST(sum(n) AS BIGINT) AS rows, count(*) AS base_rows FROM counted "
        "GROUP BY event_month, bucket HAVING count_if(n <> 1 OR changed) > 0", _DAMAGED)),
    "differing_ids": over_months(O.with_base(
        "SELECT id, n::BIGINT AS rows, 1::BIGINT AS base_rows FROM counted WHERE n <> 1 OR changed", _DAMAGED)),
    "written_integrity": O.with_base(f"SELECT * EXCLUDE (unique_ids) FROM (SELECT {C._SUMMARY_AGGS} FROM protocol_events)"),
    "created_at_check": O.with_base("SELECT count(*) AS rows, count(*) AS stamped, TRUE AS one_time, TRUE AS not_ahead FROM protocol_events"),
    "compacted_events": over_months(O.with_base("SELECT id, timestamp, event_month FROM protocol_events")),
    "emitter_known_pools": with_feed("SELECT " + ", ".join(C.KNOWN_POOL_COLUMNS) + " FROM pool_dim", _OWN_ONLY),
    "emitter_events": with_feed(f"SELECT {', '.join(C.SCAN_COLUMNS)} FROM protocol_events", _OWN_ONLY),
    "emitter_rejected": with_feed(
        "SELECT chain_id AS chain, protocol, event_name, emitter, 'foreign_emitter' AS reject_reason, count(*) AS logs FROM decoded_logs "
        f"WHERE {_CREATION} AND (emitter IS NULL OR emitter = '{fixtures.FOREIGN}') GROUP BY chain_id, protocol, event_name, emitter", _EMITTED),
    "factory_contract_logs": with_feed(
        f"SELECT f.chain_id, f.protocol, f.factory, count(l.event_name) AS logs FROM {_FACTORIES} LEFT JOIN (SELECT * FROM decoded_logs WHERE {_CREATION}) l "
        "ON l.chain_id = f.chain_id AND l.protocol = f.protocol AND lower(l.emitter) = lower(f.factory) GROUP BY f.chain_id, f.protocol, f.factory", _EMITTED),
    "dispatch_coverage": O.with_base(
        "SELECT d.protocol, d.event_name, d.event_type, d.kind, count(l.event_name) AS logs FROM (VALUES "
        + ", ".join(f"('{p}', '{n}', '{t}', '{k}')" for p in ("uniswap-v2", "pancakeswap-v2", "uniswap-v3") for n, t, k in (
            [("Swap", "swap", "pool"), ("Mint", "mint", "pool"), ("Burn", "burn", "pool")]
            + ([("Initialize", "initialize", "pool"), ("PoolCreated", "pool_created", "factory")] if p == "uniswap-v3"
               else [("Sync", "sync", "pool"), ("PairCreated", "pair_created", "factory")])))
        + ") d(protocol, event_name, event_type, kind) LEFT JOIN decoded_logs l USING (protocol, event_name) GROUP BY ALL"),
    "mainnet_events": _on_mainnet("SELECT " + ", ".join(MAINNET_COLUMNS) + " FROM protocol_events"),
    "answered_pools": _answered(f"SELECT {', '.join(C.DIM_POOL_COLUMNS)} FROM pool_dim"),
    "missing_metadata_events": with_feed(
        "SELECT id, protocol, event_type, pool_address, block_number, log_index, transaction_hash FROM protocol_events", _HOLES),
    "rejected_routes": with_feed("SELECT chain, protocol, event_name, reject_reason, count(*) AS logs FROM rejected "
                                 "GROUP BY chain, protocol, event_name, reject_reason", _MIXED),
    "mixed_route_events": with_feed(f"SELECT {', '.join(C.SCAN_COLUMNS)} FROM protocol_events", _MIXED),
    "redelivered_duplicate_ids": with_feed("SELECT id, count(*) AS copies FROM protocol_events GROUP BY id HAVING count(*) > 1", _TWICE),
    "redelivered_uniqueness": with_feed("SELECT count(*) AS total_rows, count(DISTINCT id) AS unique_ids, "
                                        "count(*) - count(DISTINCT id) AS duplicate_rows FROM protocol_events", _TWICE),
    "stream_distinct_check": O.with_base(
        f"SELECT protocol, event_type, {O.hour_of('timestamp')} AS hour, count(*) AS event_count, count(*) AS exact_count, TRUE AS pools_within, "
        "TRUE AS transactions_within FROM protocol_events GROUP BY protocol, event_type, hour"),
    "handled_events": O.with_base(f"SELECT {C._STORED} FROM pool_events_flat"),
    "handled_factories": O.with_base(f"SELECT {C._STORED} FROM factory_events_flat"),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stored_recent_events": q_stored_recent_events,
    "stored_feed20": q_stored_feed20,
    "stored_protocol_newest": q_stored_protocol_newest,
    "partial_event_stats": q_partial_event_stats,
    "partial_stats_range": q_partial_stats_range,
    "partial_hourly_rollup": q_partial_hourly_rollup,
    "stored_copy_counts": q_stored_copy_counts,
    "stored_copy_verdict": q_stored_copy_verdict,
    "copy_differences": q_copy_differences,
    "differing_ids": q_differing_ids,
    "written_integrity": q_written_integrity,
    "created_at_check": q_created_at_check,
    "compacted_events": q_compacted_events,
    "emitter_known_pools": q_emitter_known_pools,
    "emitter_events": q_emitter_events,
    "emitter_rejected": q_emitter_rejected,
    "factory_contract_logs": q_factory_contract_logs,
    "dispatch_coverage": q_dispatch_coverage,
    "mainnet_events": q_mainnet_events,
    "answered_pools": q_answered_pools,
    "missing_metadata_events": q_missing_metadata_events,
    "rejected_routes": q_rejected_routes,
    "mixed_route_events": q_mixed_route_events,
    "redelivered_duplicate_ids": q_redelivered_duplicate_ids,
    "redelivered_uniqueness": q_redelivered_uniqueness,
    "stream_distinct_check": q_stream_distinct_check,
    "handled_events": q_handled_events,
    "handled_factories": q_handled_factories,
}
