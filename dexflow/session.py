"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and shuffle sizes at run
# time; the broadcast thresholds are the size checks behind every join that
# is not a fixed constant table.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Generated methods above 8,000 bytecodes are never JIT-compiled by the JVM;
    # above this limit Spark falls back to per-operator codegen, which is.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # PySpark notes the call site of every column expression, at several driver round trips each: a plan
    # of some hundred expressions takes seconds to declare. Error messages lose the line of the expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "dexflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is also the executor (8 writers share its heap).
        conf["spark.driver.memory"] = os.environ.get("DEXFLOW_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def limit_methods(spark: SparkSession) -> None:
    """Set the limit of generated methods in a session made elsewhere, unless it has a lower one."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(DEFAULT_CONF[key]):
        spark.conf.set(key, DEFAULT_CONF[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is. Only
    when nothing is configured (local tests) a fresh scratch folder is made.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (a machine-local folder "
                               "is not visible to other executors)")
        configured = tempfile.mkdtemp(prefix="dexflow-ckpt-", dir=os.environ.get("DEXFLOW_SCRATCH", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
