"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Two kinds of work are timed, each as 1 warm-up + median of N runs:
* pipeline queries over the raw ``events`` table (normalise, discover pools,
  enrich, flatten), forced with the no-op sink, fresh plans each run;
* reports over the stored, month-partitioned event table, written once by
  the ingest job (which is timed too).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dexflow.operators import checks, reports  # noqa: E402
from dexflow.plans import catalog  # noqa: E402
from dexflow.session import build_session  # noqa: E402
from dexflow.sources import partials, store  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


SPREAD: dict[str, list[float]] = {}


def timed(fn, runs: int = RUNS, name: str | None = None) -> float:
    """Median of ``runs`` runs after a warm-up; the least and the most go to ``SPREAD``."""
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    if name:
        SPREAD[name] = [round(min(samples), 4), round(max(samples), 4)]
    return round(statistics.median(samples), 4)


def fresh(name):
    """A pipeline query from scratch: new plans, new pool dimension."""
    def go():
        catalog._CACHE.clear()
        run(catalog.QUERIES[name](spark, SF_DIR))
    return go


if __name__ == "__main__":
    spark = build_session(f"local[{CPUS}]", int(CPUS) * 2, app_name="dexflow-bench")
    scratch = tempfile.mkdtemp(prefix="dexflow-bench-", dir=os.environ.get("DEXFLOW_SCRATCH", "/tmp"))
    table = os.path.join(scratch, "protocol_events")
    results: dict[str, float] = {}

    # Pipeline queries over the raw events.
    for name in ["flatten_events", "discovered_events", "event_stats", "hourly_rollup", "top_groups"]:
        results[name] = timed(fresh(name), name=name)

    # Ingest: build the event table and write it partitioned + sorted + bloom-indexed.
    def ingest():
        catalog._CACHE.clear()
        store.write_events(catalog.context(spark, SF_DIR).events, table, mode="overwrite")
    results["ingest_write"] = timed(ingest, max(1, RUNS // 2), "ingest_write")

    stored = store.read_events(spark, table)
    stored_reports = {
        "stored_event_stats": lambda: run(reports.event_stats(stored)),
        "stored_hourly_rollup": lambda: run(reports.hourly_rollup(stored)),
        "stored_top_groups": lambda: run(reports.top_groups(stored)),
        "stored_recent_events": lambda: run(reports.recent_events(stored)),
        "stored_integrity": lambda: run(checks.integrity_summary(stored)),
        "stored_lookup_pool": lambda: run(stored.filter(stored.pool_address == catalog.LOOKUP_POOL)),
    }
    partial_path = os.path.join(scratch, "partials")
    t0 = time.perf_counter()
    partials.write_partials(stored, partial_path)
    results["partials_write_1run"] = round(time.perf_counter() - t0, 4)
    stored_reports |= {
        "partial_event_stats": lambda: run(partials.event_stats(spark, partial_path)),
        "stored_newest_10": lambda: run(store.newest_events(spark, table, 10)),
    }
    for name, fn in stored_reports.items():
        results[name] = timed(fn, name=name)

    # Streaming ingest: stage the decoded logs as time-ordered files and run the
    # checkpointed foreachBatch job to completion (one run; includes staging).
    from dexflow.streaming.replay import run_file_stream
    catalog._CACHE.clear()
    ctx = catalog.context(spark, SF_DIR)
    t0 = time.perf_counter()
    job = run_file_stream(spark, ctx.logs, ctx.dims, root=os.path.join(scratch, "stream"))
    results["stream_ingest_staged_1run"] = round(time.perf_counter() - t0, 4)
    # event_stats answered from the stream's rollup partials (no raw scan)
    results["stream_stats_from_partials"] = timed(lambda: run(job.read_stats()))

    headline = ["flatten_events", "discovered_events", "event_stats", "hourly_rollup", "top_groups"]
    print(json.dumps({
        "metric": "headline_pipeline_total",
        "value": round(sum(results[k] for k in headline), 4),
        "unit": "sec",
        "queries": results,
        "spread": SPREAD,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": int(CPUS),
        "runs": RUNS,
    }))
    spark.stop()
