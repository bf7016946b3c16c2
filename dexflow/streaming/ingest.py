"""Streaming ingest (O-59..O-64): the batch transforms inside a checkpointed ``foreachBatch``.

Before the sink, the stream normalises the logs (same code as batch) and drops what was delivered
before: ``dropDuplicatesWithinWatermark`` on the event id, with its state in RocksDB. That settles
redelivery inside the watermark at any distance in batches. Logs that the state does not
pass (copies, and logs older than the watermark, of either kind) are few; they are compared with the
stored table itself, in the months and times they come from, and those not there are genuine late
logs, which are stored like any other. So a copy never counts and a late log is never lost.

Per micro-batch, in one function:

1. discovery: register first-seen pools in the durable pool table (the
   batch's rows go to partition ``batch_id=B``, replaced on replay), then join
   the same batch to the pools with the (block, log_index) range
   condition, so events before a pool's creation in the same batch are
   excluded. Pool logs without a pool yet (or before its creation, as far as
   known) wait in the quarantine; a batch that registers a pool, or an earlier
   creation of one, takes that pool's logs from there, so files in any order
   end in the batch answer. An event comes out in the one batch from which on the
   registry matches it;
2. write the event rows to ``event_month=M/batch_id=B`` with dynamic partition
   overwrite: a batch replayed after a crash replaces itself (exactly-once
   output on top of the checkpointed offsets);
3. write hourly rollup partials with HLL sketches, merged at read time;
4. keep the newest 20 events (the live feed) as one small versioned file;
5. hand the batch to user callbacks (``standardizedEvent`` / ``factoryEvent``), once each (see ``handlers``).

Trigger: ``processingTime`` (default 5 s, the reference's flush interval) with a
rate limit per trigger; tests use ``availableNow``. State lives in the
checkpoint folder and the tables; the registry of pools is also kept in the executors' cache
between batches, and read again from its table whenever a batch does not follow the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import schemas
from ..functions import exprs as X
from ..operators import enrich, normalize, reports
from ..plans import events as E
from ..sources import dims as D
from ..sources import files, store
from .handlers import Handler, HandlerLog
from .quarantine import Quarantine

ROLLUP_SKETCH_LG_K = 12

#: How much older than the newest log a log may be and still be compared by the state store alone.
REDELIVERY_WINDOW = "2 hours"

#: What the stream keeps of a normalised log, enough to attach its pool and flatten it later.
LOG_COLUMNS = ["id", "chain", "chain_id", "protocol", "version", "event_type", "kind", "pool_address", "transaction_hash", "block_number",
               "log_index", "observed_at_ms", "token0_address", "token1_address", "fee", "tick_spacing", "event_data", "data_fee"]
WAITING = ("id string, chain int, chain_id int, protocol string, version string, event_type string, kind string, pool_address string, "
           "transaction_hash string, block_number bigint, log_index bigint, observed_at_ms bigint, token0_address string, "
           "token1_address string, fee int, tick_spacing int, event_data string, data_fee string, pool_key string")

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Batches without data would only clean the state; the next batch with data does that too.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalized_logs(logs: DataFrame) -> DataFrame:
    """``LOG_COLUMNS`` of the accepted logs, with the id that the stored event will have."""
    id_ = F.when(F.col("kind") == "factory", X.factory_event_id("transaction_hash", "log_index", "event_type")).otherwise(
        X.event_id("transaction_hash", "log_index", "event_type"))
    return E.routed_logs(logs).withColumn("id", id_).select(*LOG_COLUMNS)


def first_deliveries(logs_stream: DataFrame, window: str = REDELIVERY_WINDOW) -> DataFrame:
    """``LOG_COLUMNS`` and ``first``: every log once as it comes, and once more, marked, if the state store passes it."""
    logs = normalized_logs(logs_stream)
    timed = logs.withColumn("event_time", F.timestamp_millis(F.coalesce("observed_at_ms", F.lit(0))))
    passed = timed.withWatermark("event_time", window).dropDuplicatesWithinWatermark(["id"])
    return passed.select(*LOG_COLUMNS, F.lit(True).alias("first")).unionByName(logs.withColumn("first", F.lit(False)))


class EventIngestJob:
    """Stream of decoded logs -> event table, pool table, rollup partials, feed."""

    def __init__(self, spark: SparkSession, root: str, dims: E.Dimensions,
                 on_event: list[Handler] | None = None, on_factory: list[Handler] | None = None,
                 feed_size: int = 20, checkpoint_location: str | None = None,
                 redelivery_window: str = REDELIVERY_WINDOW, compact_every: int = 20, state_partitions: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._checkpoint = checkpoint_location
        self.dims = dims
        self.on_event = list(on_event or [])
        self.on_factory = list(on_factory or [])
        self.feed_size = feed_size
        self.redelivery_window = redelivery_window
        self.files_per_batch = 1  # files of a staged source that one batch reads
        self.state_partitions = state_partitions  # of the state store and the batches' shuffles; the session's setting if not given
        self.quarantine = Quarantine(spark, f"{self.root}/quarantine", WAITING, compact_every=compact_every)
        self.handler_log = HandlerLog(spark, f"{self.root}/handlers")
        self._registry: tuple[int, DataFrame, DataFrame] | None = None  # the batch it is good for, the pools, with their tokens

    # -- locations -----------------------------------------------------------
    @property
    def events_path(self) -> str:
        return f"{self.root}/protocol_events"

    @property
    def pools_path(self) -> str:
        return f"{self.root}/pools"

    @property
    def rollup_path(self) -> str:
        return f"{self.root}/rollup_partials"

    @property
    def feed_path(self) -> str:
        return f"{self.root}/feed"

    @property
    def deliveries_path(self) -> str:
        return f"{self.root}/deliveries"

    @property
    def checkpoint_path(self) -> str:
        return self._checkpoint or f"{self.root}/_checkpoint"

    # -- pool table ----------------------------------------------------------
    def _try_read(self, path: str) -> DataFrame | None:
        """Read a table that may not exist yet (works on any Hadoop file system)."""
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:
            return None

    def register_seeds(self) -> None:
        """Seeds are registered before the first batch (partition batch_id=-1, idempotent)."""
        seeds = enrich.known_pools(enrich.pool_tokens(self.dims.seeds, self.dims.pool_contract_tokens), self._empty_factory())
        self._write_pools(seeds, -1)

    def _empty_factory(self) -> DataFrame:
        cols = ["pool_address", "protocol", "chain_id", "token0_address", "token1_address", "fee", "tick_spacing",
                "block_number", "log_index", "transaction_hash", "observed_at_ms"]
        schema = {f.name: f.dataType for f in schemas.DECODED_LOGS.fields}
        return self.spark.createDataFrame([], ", ".join(f"{c} {schema[c].simpleString()}" for c in cols))

    def _write_pools(self, pools: DataFrame, batch_id: int) -> None:
        (pools.select(*enrich.POOL_COLUMNS).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").parquet(self.pools_path))

    def known_pools(self, up_to_batch: int | None = None) -> DataFrame:
        """All registered pools (a seed or the earliest creation wins), optionally as of a batch."""
        pools = self.spark.read.parquet(self.pools_path)
        if up_to_batch is not None:
            pools = pools.filter(F.col("batch_id") <= up_to_batch)
        return enrich.first_registrations(pools)

    def _with_tokens(self, pools: DataFrame) -> DataFrame:
        return enrich.resolve_pool_tokens(pools.withColumn("version", normalize.version_column("protocol")),
                                          self.dims.known_tokens, self.dims.token_metadata)

    def _registry_before(self, batch_id: int) -> DataFrame:
        """The pools registered before ``batch_id``: those kept from the batch before, else from the table."""
        if self._registry is None or self._registry[0] != batch_id:
            self._forget_registry()
            pools = self.known_pools(batch_id - 1).persist()
            self._registry = (batch_id, pools, self._with_tokens(pools).persist())
        return self._registry[1]

    def _forget_registry(self) -> None:
        for df in self._registry[1:] if self._registry else ():
            df.unpersist()
        self._registry = None

    # -- one micro-batch -----------------------------------------------------
    def process_batch(self, logs: DataFrame, batch_id: int) -> None:
        """Store a batch of decoded logs of which nothing is known: all are compared with the stored table."""
        self._process(normalized_logs(logs).withColumn("first", F.lit(False)), batch_id)

    def _process(self, delivered: DataFrame, batch_id: int) -> None:
        """``delivered``: as ``first_deliveries`` gives it."""
        delivered = delivered.persist()
        held: list[DataFrame] = [delivered]
        try:
            if self._try_read(self.pools_path) is None:
                self.register_seeds()
            prior = self._registry_before(batch_id)
            self.quarantine.compact_if_due(batch_id, prior)
            first = delivered.filter("first").drop("first")
            n = delivered.agg(F.count_if("first").alias("first"), F.count_if(~F.col("first")).alias("all")).first()
            logs, again = first, n["all"] - n["first"]
            if again:
                late = self._not_stored(delivered.filter(~F.col("first")).drop("first").join(first.select("id"), "id", "left_anti"), batch_id)
                logs = first.unionByName(late.select(*LOG_COLUMNS)).persist()
                held.append(logs)

            # (1) discovery: first creation per pool in this batch, unless registered from an earlier one.
            fresh = enrich.new_registrations(enrich.first_pools(logs.filter(F.col("kind") == "factory")), prior).persist()
            held.append(fresh)
            registered, ready, tokens = prior, logs, self._registry[2]
            new = fresh.count()
            if new:
                self._write_pools(fresh, batch_id)
                registered = enrich.first_registrations(fresh.select(*enrich.POOL_COLUMNS).unionByName(prior)).persist()
                tokens = self._with_tokens(registered).persist()
                released = enrich.split_by_pools(self.quarantine.held(batch_id, fresh), fresh, matched=True)
                released = enrich.split_by_pools(released, prior, matched=False)
                ready = logs.unionByName(released.select(*LOG_COLUMNS))

            # (2) idempotent event write. The registry is kept in memory: counted, no copy per batch.
            joined = enrich.attach_pools(ready, tokens, passthrough=F.col("kind") == "factory", write_dimension=False, mark_unmatched="waits")
            joined = joined.persist()
            held.append(joined)
            rows = E.flatten_all(joined.filter(~F.col("waits")))
            if new or again:
                rows = store.dedupe_by_id(rows)  # a log may wait twice, or come twice among the late ones
            rows = rows.persist()
            held.append(rows)
            store.write_events(rows, self.events_path, batch_id=batch_id, bloom=True, shuffle=False)
            if again:
                self._write_deliveries(n["first"], logs, again, batch_id)

            # (3) rollup partials, (4) feed, (5) callbacks, all from this batch's rows
            # (the growing event table is never listed or re-read here).
            self._write_rollup(rows, batch_id)
            self._write_feed(rows, batch_id)
            waits = joined.filter("waits")
            if not waits.isEmpty():
                key = X.pool_key(F.col("chain"), "pool_address")
                self.quarantine.add(waits.filter(F.col("pool_address").isNotNull()).withColumn("pool_key", key)
                                    .select(*LOG_COLUMNS, "pool_key"), batch_id)
            factory = F.col("event_type").isin(D.FACTORY_EVENT_TYPES)
            for label, fns, mine in (("on_event", self.on_event, ~factory), ("on_factory", self.on_factory, factory)):
                for i, fn in enumerate(fns):
                    name = f"{label}_{i}_{getattr(fn, '__name__', 'handler').strip('<>')}"
                    self.handler_log.call(name, fn, rows.filter(mine), batch_id)
            # After a registration the pools are read from their table again: a plan that went on from batch to batch would grow.
            if new:
                held += [registered, tokens]
                self._forget_registry()
            else:
                self._registry = (batch_id + 1, registered, tokens)
        except BaseException:
            self._forget_registry()
            raise
        finally:
            for df in reversed(held):
                df.unpersist()

    def _not_stored(self, logs: DataFrame, batch_id: int) -> DataFrame:
        """The ``logs`` that no batch before ``batch_id`` has stored or put into the quarantine.

        A log delivered again has the time it had, so only the months of these logs are listed,
        and only files and row groups that reach into their times are read.
        """
        logs = logs.dropDuplicates(["id"]).persist()
        keyed = logs.filter(F.col("pool_address").isNotNull()).withColumn("pool_key", X.pool_key(F.col("chain"), "pool_address"))
        waiting = self.quarantine.held(batch_id, keyed)
        month = X.year_month("observed_at_ms")
        span = logs.agg(F.collect_set(month).alias("months"), F.min("observed_at_ms").alias("lo"), F.max("observed_at_ms").alias("hi"),
                        F.count_if(F.col("observed_at_ms").isNull()).alias("timeless")).first()  # few values: months
        names = [str(m) for m in span["months"]] + ["__HIVE_DEFAULT_PARTITION__"] * bool(span["timeless"])
        folders = [f"{self.events_path}/event_month={m}" for m in names if files.exists(self.spark, f"{self.events_path}/event_month={m}")]
        logs = logs.join(waiting.select("id"), "id", "left_anti")
        if not folders:
            return logs
        stored = self.spark.read.option("basePath", self.events_path).parquet(*folders).filter(F.col("batch_id") < batch_id)
        within = F.col("timestamp").between(F.lit(span["lo"]), F.lit(span["hi"]))
        stored = stored.filter(within | F.col("timestamp").isNull() if span["timeless"] else within)
        return logs.join(stored.select("id"), "id", "left_anti")

    def _write_deliveries(self, first: int, logs: DataFrame, again: int, batch_id: int) -> None:
        """What the batch got: logs for the first time, copies (of either kind), and late ones that were new."""
        late = F.count(F.lit(1)) - F.lit(int(first))
        counts = logs.agg(F.lit(int(first)).alias("first_logs"), late.alias("late_logs")).withColumn(
            "copies", F.lit(int(again)) - F.col("late_logs"))
        (counts.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.deliveries_path))

    def _write_rollup(self, rows: DataFrame, batch_id: int) -> None:
        partial = (rows.withColumn("hour", X.hour_start("timestamp"))
                       .groupBy("protocol", "event_type", "hour")
                       .agg(F.count(F.lit(1)).alias("event_count"),
                            F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms"),
                            F.hll_sketch_agg("pool_address", ROLLUP_SKETCH_LG_K).alias("pools_sketch"),
                            F.hll_sketch_agg("transaction_hash", ROLLUP_SKETCH_LG_K).alias("tx_sketch")))
        (partial.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id").parquet(self.rollup_path))

    def _feed_slot(self, batch_id: int) -> str:
        return f"{self.feed_path}/slot_{batch_id % 2}"

    def _write_feed(self, rows: DataFrame, batch_id: int) -> None:
        """Newest ``feed_size`` events so far: this batch's rows merged with the previous batch's feed.

        Two slots alternate: batch B reads slot (B-1) % 2 and overwrites slot B % 2,
        so the read never lists more than one small folder and a replay of B
        still finds B-1's feed.
        """
        candidates = rows.select(*reports.FEED_COLUMNS)
        prev = self._try_read(self._feed_slot(batch_id - 1))
        if prev is not None:
            candidates = candidates.unionByName(prev.filter(F.col("batch_id") < batch_id).select(*reports.FEED_COLUMNS))
        # An event delivered again in a later batch stands in the feed once.
        top = candidates.dropDuplicates(["id"]).orderBy(*reports.newest_first()).limit(self.feed_size)
        (top.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).coalesce(1)
            .write.mode("overwrite").parquet(self._feed_slot(batch_id)))

    # -- running ---------------------------------------------------------------
    def start(self, logs_stream: DataFrame, trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
        """Start the checkpointed query. ``trigger`` defaults to every 5 seconds."""
        self.register_seeds()
        writer = (first_deliveries(logs_stream, self.redelivery_window).writeStream.foreachBatch(self._process)
                  .option("checkpointLocation", self.checkpoint_path))
        if query_name:
            writer = writer.queryName(query_name)
        writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
        settings = STATE_STORE | ({"spark.sql.shuffle.partitions": str(self.state_partitions)} if self.state_partitions else {})
        before = {k: self.spark.conf.get(k, None) for k in settings}
        try:  # a query keeps the settings that hold when it starts
            for k, v in settings.items():
                self.spark.conf.set(k, v)
            return writer.start()
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    # -- readers -----------------------------------------------------------------
    def read_events(self, dedupe: bool = True) -> DataFrame:
        df = self.spark.read.parquet(self.events_path).drop("batch_id")
        return store.one_per_id(df) if dedupe else df

    def read_rollup(self) -> DataFrame:
        return read_rollup(self.spark, self.rollup_path)

    def read_stats(self, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
        return read_stats(self.spark, self.rollup_path, start_ms, end_ms)

    def read_feed(self) -> DataFrame:
        """The feed of the newest batch (the slot whose rows carry the higher batch id)."""
        slots = [df for df in (self._try_read(f"{self.feed_path}/slot_{i}") for i in (0, 1)) if df is not None]
        df = slots[0] if len(slots) == 1 else slots[0].unionByName(slots[1])
        newest = df.agg(F.max("batch_id").alias("b"))
        return df.join(newest, df["batch_id"] == newest["b"], "left_semi").drop("batch_id")


#: Relative standard error of a distinct count from a merged sketch.
SKETCH_ERROR = 1.04 / 2 ** (ROLLUP_SKETCH_LG_K / 2)


def check_distincts(rollup: DataFrame, events: DataFrame, errors: float = 3.0) -> DataFrame:
    """Do the rollup's distinct counts lie within ``errors`` standard errors of the exact ones (at least 1)?

    Per group and hour: event_count of both, and ``pools_within`` and ``transactions_within``. Groups that only one side has show with null.
    """
    keys = ["protocol", "event_type", "hour"]
    exact = reports.hourly_rollup(events).withColumnsRenamed({"event_count": "n", "unique_pools": "p", "unique_transactions": "t"})
    near = lambda estimate, true: F.abs(F.col(estimate) - F.col(true)) <= F.greatest(F.lit(1.0), errors * SKETCH_ERROR * F.col(true))
    return rollup.join(exact, keys, "full").select(*keys, "event_count", F.col("n").alias("exact_count"),
                                                   near("unique_pools", "p").alias("pools_within"),
                                                   near("unique_transactions", "t").alias("transactions_within"))


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """Merge the per-batch partials: counts add, sketches union (distincts are estimates)."""
    parts = spark.read.parquet(path)
    return (parts.groupBy("protocol", "event_type", "hour")
                 .agg(F.sum("event_count").alias("event_count"),
                      F.hll_sketch_estimate(F.hll_union_agg("pools_sketch")).alias("unique_pools"),
                      F.hll_sketch_estimate(F.hll_union_agg("tx_sketch")).alias("unique_transactions")))


def read_stats(spark: SparkSession, path: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """O-44 from the rollup partials: per (protocol, event_type) stats over whole hours, without a raw scan.

    Counts and first/last times are exact; distinct pools and transactions
    come from merged HLL sketches (estimates). The partials table grows with
    groups x hours x batches, not with events, so this answers over any range
    of a 100 TB table by reading a small table. ``start_ms``/``end_ms`` select
    whole hours (an hour is kept when it starts inside the range).
    """
    parts = spark.read.parquet(path)
    if start_ms is not None:
        parts = parts.filter(F.col("hour") >= X.seconds_time(F.lit(int(start_ms))))
    if end_ms is not None:
        parts = parts.filter(F.col("hour") < X.seconds_time(F.lit(int(end_ms))))
    return (parts.groupBy("protocol", "event_type")
                 .agg(F.sum("event_count").alias("event_count"),
                      F.hll_sketch_estimate(F.hll_union_agg("pools_sketch")).alias("unique_pools"),
                      F.hll_sketch_estimate(F.hll_union_agg("tx_sketch")).alias("unique_transactions"),
                      X.seconds_time(F.min("first_ms")).alias("first_event"),
                      X.seconds_time(F.max("last_ms")).alias("last_event")))


def stream_hourly_rollup(events_stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """O-62 as a native streaming aggregate over a stream of stored events.

    Event time is the observed time; the watermark bounds state and drops rows
    later than ``delay``. Exact distinct counts are not allowed on streams, so
    the distincts are HyperLogLog estimates.
    """
    t = events_stream.withColumn("event_time", X.seconds_time("timestamp").cast("timestamp"))
    return (t.withWatermark("event_time", delay)
             .groupBy(F.window("event_time", "1 hour").alias("w"), "protocol", "event_type")
             .agg(F.count(F.lit(1)).alias("event_count"),
                  F.approx_count_distinct("pool_address").alias("unique_pools"),
                  F.approx_count_distinct("transaction_hash").alias("unique_transactions"))
             .select("protocol", "event_type", F.col("w.start").cast("timestamp_ntz").alias("hour"),
                     "event_count", "unique_pools", "unique_transactions"))


class ErrorListener(StreamingQueryListener):
    """O-64 ``error`` callback: called with (query id, message) when a query stops with an exception."""

    def __init__(self, on_error: Callable[[str, str], None]):
        self.on_error = on_error

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.on_error(str(event.id), event.exception)
