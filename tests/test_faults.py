"""Task failures are retried and the results are unchanged (a separate Spark process with retries on)."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

SCRIPT = r'''
import json, sys, tempfile
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from dexflow.session import DEFAULT_CONF
from dexflow.plans.events import Dimensions, build_event_table
from dexflow.operators import reports
from dexflow.sources import fixtures, store

builder = SparkSession.builder.master("local[4, 3]").config("spark.sql.shuffle.partitions", "4")
for k, v in DEFAULT_CONF.items():
    builder = builder.config(k, v)
spark = builder.getOrCreate()
spark.sparkContext.setLogLevel("OFF")
raw = spark.read.parquet(sys.argv[2] + "/events.parquet").repartition(4)

marks = tempfile.mkdtemp(prefix="faults-marks-")

def flaky(batches):
    import os
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0:          # every task's first attempt dies
        open(os.path.join(marks, f"stage-{ctx.stageId()}-part-{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    yield from batches

d = Dimensions(fixtures.pool_seed(spark), fixtures.token_known(spark))
out = {}
for label, events in (("clean", raw), ("flaky", raw.mapInPandas(flaky, raw.schema))):
    table = build_event_table(fixtures.decoded_logs_from_events(events), d)
    path = tempfile.mkdtemp(prefix="faults-") + "/t"
    store.write_events(table, path, mode="overwrite")
    stored = spark.read.parquet(path)
    stats = sorted(tuple(str(v) for v in r) for r in reports.event_stats(stored).collect())
    ids = stored.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("u")).first()
    out[label] = {"stats": stats, "rows": ids.n, "unique": ids.u}
import os
out["injected"] = len(os.listdir(marks))
out["marks"] = sorted(os.listdir(marks))
print("RESULT " + json.dumps(out))
'''


def test_injected_task_failures_are_retried_with_same_results(tmp_path):
    script = tmp_path / "faults.py"
    script.write_text(SCRIPT)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, DEXFLOW_SCRATCH=str(tmp_path))
    proc = subprocess.run([sys.executable, str(script), repo, SF_SMALL], capture_output=True, text=True,
                          timeout=600, env=env)
    lines = [line for line in proc.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, proc.stderr[-2000:]
    res = json.loads(lines[-1][len("RESULT "):])
    assert res["injected"] >= 4          # failures really happened, in several tasks
    assert res["flaky"] == res["clean"]
    assert res["clean"]["rows"] == res["clean"]["unique"] > 0
