"""Streaming delivery: copies at any distance, late logs, quarantine that shrinks, handlers called once."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow.operators import enrich
from dexflow.plans import events as E
from dexflow.sources import files, fixtures, tables
from dexflow.streaming import handlers, ingest
from dexflow.streaming.ingest import EventIngestJob
from dexflow.streaming.quarantine import Quarantine


def run(spark, src, root, dims, **options):
    job = EventIngestJob(spark, root, dims, **options)
    q = job.start(tables.stream_decoded_logs(spark, src, max_files_per_trigger=1), trigger={"availableNow": True})
    q.awaitTermination(900)
    assert q.exception() is None
    return job, q


def test_copies_and_late_logs(spark, fx_dims, tmp_path):
    """Copies inside and far outside the watermark add nothing; a log that is late, but new, is stored."""
    logs, src = fixtures.decoded_logs(spark, SF_SMALL), str(tmp_path / "src")
    lo, hi = logs.agg(F.min("observed_at_ms"), F.max("observed_at_ms")).first()
    late = F.col("block_number") % 10 == 3
    old, t = lo + (hi - lo) // 2, F.col("observed_at_ms")
    for part in (logs.filter((t < old) & ~late), logs.filter(t >= old), logs.filter(t >= hi - 3_600_000), logs.filter((t < old) & late),
                 logs.filter(t < old)):
        part.coalesce(1).write.mode("append").parquet(src)
    job, q = run(spark, src, str(tmp_path / "out"), fx_dims)
    batch = E.build_event_table(logs, fx_dims)
    got = job.read_events(dedupe=False)
    assert got.count() == batch.count() and got.select("id").exceptAll(batch.select("id")).count() == 0
    assert job.read_rollup().agg(F.sum("event_count")).first()[0] == batch.count()
    counts = spark.read.parquet(job.deliveries_path).agg(F.sum("late_logs"), F.sum("copies")).first()
    accepted = E.routed_logs(logs)
    assert counts[0] == accepted.filter((t < old) & late).count()
    assert counts[1] == accepted.filter(t >= hi - 3_600_000).count() + accepted.filter(t < old).count()
    # The state store settles copies inside the watermark and drops older logs as late.
    assert sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators) > 0


def test_copy_after_more_than_a_hundred_batches(spark, tmp_path):
    """What comes in front of the sink knows a copy inside the watermark at any distance in batches."""
    logs, src = fixtures.decoded_logs(spark, SF_SMALL).orderBy("block_number"), str(tmp_path / "src")
    rows = logs.limit(108).collect()
    for part in [rows[:4], *([r] for r in rows[4:]), rows[:4]]:
        spark.createDataFrame(part, logs.schema).coalesce(1).write.mode("append").parquet(src)
    first, settings = [], dict(ingest.STATE_STORE, **{"spark.sql.shuffle.partitions": "1"})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        stream = ingest.first_deliveries(tables.stream_decoded_logs(spark, src, max_files_per_trigger=1), "4000 days")
        q = (stream.writeStream.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True)
             .foreachBatch(lambda df, b: first.extend(r["id"] for r in df.filter("first").select("id").collect())).start())
        q.awaitTermination(600)
        assert q.exception() is None and q.lastProgress.batchId > 100
        assert 0 < len(first) == len(set(first)) <= 108
        assert not sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


WAITING = [f.split()[0] for f in ingest.WAITING.split(", ")]


def waiting(spark, rows):
    """Logs that wait: (pool, block) pairs."""
    base = dict.fromkeys(WAITING)
    made = [{**base, "id": f"{p}-{b}", "chain": 1, "chain_id": 1, "protocol": "uniswap-v2", "kind": "pool", "pool_address": p, "pool_key": f"1:{p}",
             "block_number": b, "log_index": 0} for p, b in rows]
    return spark.createDataFrame([tuple(m[c] for c in WAITING) for m in made], ingest.WAITING)


def registry(spark, pools):
    rows = [(f"1:{p}", "uniswap-v2", False, b, 0) for p, b in pools]
    return spark.createDataFrame(rows, "pool_key string, protocol string, is_seed boolean, created_block long, created_log_index long")


def test_quarantine_reads_few_files_and_drops_what_was_released(spark, tmp_path):
    q = Quarantine(spark, str(tmp_path / "q"), ingest.WAITING, buckets=8, compact_every=5)
    pools, counts, known = [f"0x{i:02x}" for i in range(16)], [], []
    for b in range(31):
        q.compact_if_due(b, registry(spark, known))
        if b % 3 == 2:
            known.append((pools[b // 3], 10))
        fresh = registry(spark, known[-1:])
        held = q.held(b, fresh)
        counts.append(len(held.inputFiles()))
        if b % 3 == 2:
            mine = held.filter(F.col("pool_key") == f"1:{pools[b // 3]}")
            assert {r["block_number"] for r in mine.collect()} == {100 + k for k in range(b)}
        q.add(waiting(spark, [(p, 100 + b) for p in pools if (p, 10) not in known]), b)
    assert max(counts[10:]) <= 6  # the snapshot's file of a bucket and at most five deltas
    left = q._read(q._folders(30, 31))
    assert {r["pool_address"] for r in left.select("pool_address").distinct().collect()} == set(pools) - {p for p, _ in known}
    # A batch that runs again finds what it found.
    again = sorted(r["id"] for r in q.held(30, registry(spark, [(pools[15], 10)])).collect())
    q.compact_if_due(30, registry(spark, known))
    assert again == sorted(r["id"] for r in q.held(30, registry(spark, [(pools[15], 10)])).collect())


def test_handlers_are_called_once_per_batch(spark, tmp_path):
    log, calls = handlers.HandlerLog(spark, str(tmp_path / "h")), []
    df = spark.range(1)

    def fn(rows, batch_id):
        calls.append(batch_id)
        if batch_id == 2 and calls.count(2) == 1:
            raise RuntimeError("half-way")

    assert log.call("f", fn, df, 1) and not log.call("f", fn, df, 1) and log.call("g", fn, df, 1)
    with pytest.raises(RuntimeError):
        log.call("f", fn, df, 2)
    assert log.call("f", fn, df, 2)
    assert calls == [1, 1, 2, 2]
    for b in range(3, 40):
        log.call("f", fn, df, b)
    assert len(files.names(spark, str(tmp_path / "h" / "f"))) <= handlers.KEPT


def test_foreign_creation_logs_register_nothing_in_a_stream(spark, fx_dims, tmp_path):
    logs = fixtures.with_emitters(fixtures.decoded_logs(spark, SF_SMALL))
    job = EventIngestJob(spark, str(tmp_path / "out"), fx_dims)
    job.process_batch(logs, 0)
    pools = E.pool_dimension(E.routed_logs(logs), fx_dims)
    assert job.known_pools().select("pool_key", "created_block").exceptAll(pools.select("pool_key", "created_block")).count() == 0
    assert job.read_events().count() == E.build_event_table(logs, fx_dims).count()
    src = str(tmp_path / "src")
    logs.coalesce(1).write.parquet(src)
    assert "emitter" in tables.read_decoded_logs(spark, src, emitter=True).columns
    assert "emitter" in tables.stream_decoded_logs(spark, src, emitter=True).columns


def test_seed_tokens_by_contract_answer(spark, fx_dims):
    answers = spark.createDataFrame([(1, "0x" + "0" * 39 + "1", "0xAA", "0xBB"), (56, "0x" + "0" * 39 + "2", "0xCC", "0xDD"), (1, "0x" + "0" * 39 + "3", None, "0xEE")],
                                    "chain_id int, pool_address string, token0_address string, token1_address string")
    got = {r["pool_address"][-1]: (r["token0_address"], r["token1_address"]) for r in
           enrich.pool_tokens(fx_dims.seeds, answers).filter("chain_id = 1").collect()}
    seeds = {r["pool_address"][-1]: (r["token0_address"], r["token1_address"]) for r in fx_dims.seeds.filter("chain_id = 1").collect()}
    assert got["1"] == ("0xAA", "0xBB")
    assert got["2"] == seeds["2"]  # the answer is another chain's
    assert got["3"] == (seeds["3"][0], "0xEE")
