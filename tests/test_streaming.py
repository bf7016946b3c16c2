"""Streaming ingest equals its batch twin; replays are idempotent; rollup and feed agree."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow import schemas
from dexflow.operators import reports
from dexflow.plans import events as E
from dexflow.sources import fixtures, tables
from dexflow.streaming.ingest import EventIngestJob, ErrorListener, stream_hourly_rollup

COLS = [c for c in schemas.EVENT_COLUMNS if c != "created_at"]


def _stage_logs(spark, path, chunks=4):
    """Write the decoded logs in time order as ``chunks`` appends (one file each)."""
    from dexflow.streaming.replay import stage_in_time_order
    logs = fixtures.decoded_logs(spark, SF_SMALL)
    stage_in_time_order(logs, path, chunks)
    return logs


def _run(spark, src, root, dims, **kw):
    job = EventIngestJob(spark, root, dims, **kw)
    stream = tables.stream_decoded_logs(spark, src, max_files_per_trigger=1)
    q = job.start(stream, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    return job, q


def test_stream_equals_batch(spark, fx_dims, tmp_path):
    src = str(tmp_path / "logs")
    logs = _stage_logs(spark, src)
    seen = []
    job, q = _run(spark, src, str(tmp_path / "out"), fx_dims,
                  on_event=[lambda df, b: seen.append((b, df.count()))])
    assert q.lastProgress is not None
    streamed = job.read_events().select(*COLS)
    batch = E.build_event_table(logs, fx_dims).select(*COLS)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # callbacks saw every pool event, batch by batch
    assert len(seen) >= 4 and sum(n for _, n in seen) == batch.filter(~F.col("event_type").like("%created")).count()

    # rollup: counts exact; distincts from merged sketches close to exact
    merged = {(r.protocol, r.event_type, r.hour): r for r in job.read_rollup().collect()}
    exact = {(r.protocol, r.event_type, r.hour): r for r in reports.hourly_rollup(batch).collect()}
    assert merged.keys() == exact.keys()
    for k, r in exact.items():
        assert merged[k].event_count == r.event_count
        assert abs(merged[k].unique_transactions - r.unique_transactions) <= max(1, 0.05 * r.unique_transactions)

    # stats from the partials: counts and first/last exact, distincts close
    stats = {(r.protocol, r.event_type): r for r in job.read_stats().collect()}
    exact_stats = {(r.protocol, r.event_type): r for r in reports.event_stats(batch).collect()}
    assert stats.keys() == exact_stats.keys()
    for k, r in exact_stats.items():
        s = stats[k]
        assert (s.event_count, s.first_event, s.last_event) == (r.event_count, r.first_event, r.last_event)
        assert abs(s.unique_transactions - r.unique_transactions) <= max(1, 0.05 * r.unique_transactions)
        assert abs(s.unique_pools - r.unique_pools) <= 1

    # a time range selects whole hours
    lo, hi = batch.agg(F.min("timestamp"), F.max("timestamp")).first()
    start = (lo // 3_600_000 + 24) * 3_600_000
    end = start + 48 * 3_600_000
    ranged = {(r.protocol, r.event_type): r.event_count for r in job.read_stats(start, end).collect()}
    window = batch.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    expected = {(r.protocol, r.event_type): r.event_count for r in reports.event_stats(window).collect()}
    assert ranged == expected and 0 < sum(expected.values()) < batch.count()

    # feed: newest 20 overall
    feed = sorted(r.id for r in job.read_feed().collect())
    assert feed == sorted(r.id for r in reports.feed_last(batch).collect())


def test_replay_of_a_batch_leaves_one_copy(spark, fx_dims, tmp_path):
    src = str(tmp_path / "logs")
    logs = _stage_logs(spark, src, chunks=2)
    job, _ = _run(spark, src, str(tmp_path / "out"), fx_dims)
    before = job.read_events(dedupe=False).count()
    # a crash after the write but before the commit re-delivers the last batch
    last = spark.read.parquet(job.events_path).agg(F.max("batch_id")).first()[0]
    part = spark.read.schema(schemas.DECODED_LOGS).parquet(src).withColumn("f", F.input_file_name())
    last_file = part.orderBy(F.col("block_number").desc()).first().f
    job.process_batch(part.filter(F.col("f") == last_file).drop("f"), last)
    assert job.read_events(dedupe=False).count() == before
    assert before == E.build_event_table(logs, fx_dims).count()


def test_redelivered_logs_count_once(spark, fx_dims, tmp_path):
    """A batch delivered again, alone or with new logs, adds nothing to the table, the partials or the feed."""
    logs = fixtures.decoded_logs(spark, SF_SMALL)
    early = logs.agg(F.percentile_approx("block_number", 0.5)).first()[0]
    job = EventIngestJob(spark, str(tmp_path / "out"), fx_dims)
    job.register_seeds()
    job.process_batch(logs.filter(F.col("block_number") <= early), 0)
    job.process_batch(logs.unionByName(logs.limit(50)), 1)
    job.process_batch(logs, 2)
    job.process_batch(logs, 2)
    batch = E.build_event_table(logs, fx_dims)
    n = batch.count()
    assert job.read_events(dedupe=False).count() == n
    assert job.read_rollup().agg(F.sum("event_count")).first()[0] == n
    assert job.read_stats().agg(F.sum("event_count")).first()[0] == n
    assert sorted(r.id for r in job.read_feed().collect()) == sorted(r.id for r in reports.feed_last(batch).collect())


def test_restart_keeps_discovered_pools(spark, fx_dims, tmp_path):
    src = str(tmp_path / "logs")
    _stage_logs(spark, src, chunks=2)
    root = str(tmp_path / "out")
    job, _ = _run(spark, src, root, fx_dims)
    n1 = job.known_pools().count()
    job2, _ = _run(spark, src, root, fx_dims)   # same checkpoint: nothing new to read
    assert job2.known_pools().count() == n1 and n1 >= 13


def test_native_streaming_rollup_counts(spark, fx_dims, tmp_path):
    logs = fixtures.decoded_logs(spark, SF_SMALL)
    batch = E.build_event_table(logs, fx_dims)
    path = str(tmp_path / "events")
    batch.write.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(path)
    q = (stream_hourly_rollup(stream).writeStream.outputMode("complete").format("memory")
         .queryName("rollup_test").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(r.protocol, r.event_type, r.hour): r.event_count for r in spark.table("rollup_test").collect()}
    exp = {(r.protocol, r.event_type, r.hour): r.event_count for r in reports.hourly_rollup(batch).collect()}
    assert got == exp


def test_error_listener_reports_failures(spark, tmp_path):
    errors = []
    listener = ErrorListener(lambda qid, msg: errors.append(msg))
    spark.streams.addListener(listener)
    try:
        src = str(tmp_path / "logs")
        fixtures.decoded_logs(spark, SF_SMALL).limit(5).write.parquet(src)

        def boom(df, batch_id):
            raise RuntimeError("handler failed")

        q = (tables.stream_decoded_logs(spark, src).writeStream.foreachBatch(boom)
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        try:
            q.awaitTermination(120)
        except Exception:
            pass
        import time
        for _ in range(50):
            if errors:
                break
            time.sleep(0.2)
        assert errors and "handler failed" in errors[0]
    finally:
        spark.streams.removeListener(listener)


def test_watermark_drops_late_rows(spark, fx_dims, tmp_path):
    """O-62 late-data policy: after the watermark has passed, rows older than the delay are dropped."""
    batch = E.build_event_table(fixtures.decoded_logs(spark, SF_SMALL), fx_dims).drop("created_at")
    src = str(tmp_path / "events")
    lo, hi = batch.agg(F.min("timestamp"), F.max("timestamp")).first()
    span = (hi - lo) // 4
    for i in range(4):
        (batch.filter((F.col("timestamp") >= lo + i * span) & (F.col("timestamp") < lo + (i + 1) * span))
              .coalesce(1).write.mode("append").parquet(src))
    # a late file: the first hour again, re-labelled, arriving after the newest data
    (batch.filter(F.col("timestamp") < lo + 3_600_000).withColumn("id", F.concat(F.lit("late-"), "id"))
          .coalesce(1).write.mode("append").parquet(src))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (stream_hourly_rollup(stream, delay="1 hour").writeStream.outputMode("append").format("memory")
         .queryName("late_test").trigger(availableNow=True).start())
    q.awaitTermination(300)
    dropped = sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)
    assert dropped > 0
    emitted = spark.table("late_test").agg(F.sum("event_count")).first()[0]
    assert emitted <= batch.count()      # late rows never add to closed hours


def test_restart_from_checkpoint_copy_without_last_commit(spark, fx_dims, tmp_path):
    """A crash after the last batch wrote its output but before it committed: the restarted query
    re-runs that batch, and the idempotent partitions leave the stored rows unchanged."""
    import os
    import shutil
    src = str(tmp_path / "logs")
    _stage_logs(spark, src, chunks=3)
    root = str(tmp_path / "out")
    job, _ = _run(spark, src, root, fx_dims)
    before = sorted(r.id for r in job.read_events(dedupe=False).select("id").collect())
    n_before = job.read_events(dedupe=False).count()
    ck = job.checkpoint_path
    last = max(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    copy = str(tmp_path / "ck_copy")
    # drop the last commit marker (and its checksum file) from the copy
    shutil.copytree(ck, copy, ignore=lambda d, names: [n for n in names if n in (str(last), f".{last}.crc")]
                    if d.endswith("commits") else [])
    replays = []
    job2 = EventIngestJob(spark, root, fx_dims, checkpoint_location=copy,
                          on_event=[lambda df, b: replays.append(b)])
    q = job2.start(tables.stream_decoded_logs(spark, src, max_files_per_trigger=1), trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert replays == [last]                                  # exactly the uncommitted batch ran again
    assert job2.read_events(dedupe=False).count() == n_before  # and replaced itself
    after = sorted(r.id for r in job2.read_events(dedupe=False).select("id").collect())
    assert after == before


def test_files_in_any_order_equal_batch(spark, fx_dims, tmp_path):
    from dexflow.streaming.replay import run_file_stream
    logs = fixtures.decoded_logs(spark, SF_SMALL)
    job = run_file_stream(spark, logs, fx_dims, root=str(tmp_path / "s"), newest_first=True)
    streamed = job.read_events(dedupe=False).select(*COLS)
    batch = E.build_event_table(logs, fx_dims).select(*COLS)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # The registry ends at the earliest creation, as in the batch build.
    pools = E.pool_dimension(E.routed_logs(logs), fx_dims).select("pool_key", "created_block", "created_log_index")
    assert job.known_pools().select(*pools.columns).exceptAll(pools).count() == 0
    assert sum(r.event_count for r in job.read_rollup().collect()) == batch.count()
