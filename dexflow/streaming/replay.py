"""Drive the streaming ingest over a file source to completion (tests and registered stream queries).

The decoded logs are staged as ``chunks`` time-ordered appends in a folder
under the shared checkpoint directory, then read by the file stream source one
append per trigger with ``availableNow``: the same micro-batch code path as a
live stream, run to the end of the available input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import normalize
from ..plans import events as E
from ..session import scratch_path
from ..sources import files, tables
from .ingest import EventIngestJob


ROWS_PER_CHUNK = 2_000_000

#: Below that a file of a chunk is not worth a task.
ROWS_PER_FILE = 20_000


ROW_GROUP_BYTES = 4 * 1024 * 1024


def stage_in_time_order(logs: DataFrame, path: str, chunks: int = 4, newest_first: bool = False) -> int:
    """``stage_chunks`` with one file per chunk; returns the number of chunks written."""
    return stage_chunks(logs, path, chunks, newest_first)[0]


def stage_chunks(logs: DataFrame, path: str, chunks: int = 4, newest_first: bool = False, files_per_chunk: int = 1) -> tuple[int, int]:
    """Write ``logs`` as time-ordered appends, split at block boundaries: how many chunks, and files in each.

    The bounds come from the block numbers alone. The logs are then written once, in a folder per
    chunk next to ``path``, and each chunk is appended from its folder, so staging
    costs one pass over the input instead of one per chunk. All logs of one
    block land in the same chunk, so per-batch discovery sees a pool's
    creation together with the same block's events. The number of chunks grows
    with the input (about ``ROWS_PER_CHUNK`` rows each, more where one block has more). A chunk is written
    by as many tasks as it has files, after the previous one: up to ``files_per_chunk``, with at least about ``ROWS_PER_FILE`` rows
    each. Every chunk has the same number of files, so ``maxFilesPerTrigger`` of that number makes one
    micro-batch per chunk; small row groups let the reader split them further. With ``newest_first`` the chunks are written in
    reverse, so events arrive before the creation of their pool.
    """
    spark = logs.sparkSession
    # A log without a block counts as block 0, as in the batch build; a range filter would drop it.
    logs = normalize.with_log_metadata(logs)
    rows = logs.count()
    chunks = max(chunks, -(-rows // ROWS_PER_CHUNK))
    per_chunk = max(1, min(files_per_chunk, rows // chunks // ROWS_PER_FILE))
    # The error shrinks with the number of chunks, so neighbouring bounds do not fall together.
    bounds = sorted(set(logs.approxQuantile("block_number", [i / chunks for i in range(1, chunks)], min(0.001, 0.1 / chunks))))
    chunk = sum((F.when(F.col("block_number") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    by_chunk = path.rstrip("/") + "_by_chunk"
    logs.withColumn("__chunk", chunk).write.mode("overwrite").partitionBy("__chunk").parquet(by_chunk)
    found = sorted((int(v) for v in files.values(spark, by_chunk, "__chunk")), reverse=newest_first)
    for c in found:
        _append(spark.read.schema(logs.schema).parquet(f"{by_chunk}/__chunk={c}"), path, per_chunk)
    if not found:
        _append(spark.createDataFrame([], logs.schema), path, 1)
    return max(1, len(found)), per_chunk


def _append(logs: DataFrame, path: str, n: int) -> None:
    """Append ``logs`` as exactly ``n`` files; a task without rows leaves none, so empty ones are added."""
    write = lambda df: df.write.option("parquet.block.size", ROW_GROUP_BYTES).mode("append").parquet(path)
    spark = logs.sparkSession
    before = len(_staged(spark, path))
    write(logs.coalesce(1) if n == 1 else logs.repartition(n))
    for _ in range(n - (len(_staged(spark, path)) - before)):
        write(spark.createDataFrame([], logs.schema).coalesce(1))


def _staged(spark: SparkSession, path: str) -> list[str]:
    """The staged files in the order in which the stream reads them."""
    return [n for n in files.names(spark, path, oldest_first=True) if n.endswith(".parquet")]


def replay_last_batch(job: EventIngestJob, source: str) -> None:
    """Run the newest batch of a finished job again, as after a crash before its commit."""
    last = job.spark.read.parquet(job.events_path).agg(F.max("batch_id")).first()[0]
    newest = _staged(job.spark, source)[-job.files_per_batch:]
    job.process_batch(job.spark.read.schema(schemas.DECODED_LOGS).parquet(*[f"{source}/{n}" for n in newest]), last)


def run_file_stream(spark: SparkSession, logs: DataFrame, dims: E.Dimensions, chunks: int = 4,
                    root: str | None = None, timeout_s: int | None = None, redeliver: bool = False,
                    newest_first: bool = False, job_options: dict | None = None) -> EventIngestJob:
    """Stage ``logs``, run the ingest job until the staged input is consumed, return the job (its tables).

    There is no time limit unless ``timeout_s`` is given; a run that reaches it is stopped and
    raises TimeoutError, so no caller reads incomplete tables. With ``redeliver`` the newest
    quarter of the blocks arrives a second time at the end;
    with ``newest_first`` the chunks arrive in reverse order.
    """
    root = root or scratch_path(spark, "dexflow-stream")
    source = f"{root}/source"
    cores = spark.sparkContext.defaultParallelism
    batches, per_batch = stage_chunks(logs, source, chunks, newest_first, files_per_chunk=cores)
    if redeliver:
        staged = spark.read.parquet(source)
        newest = staged.approxQuantile("block_number", [0.75], 0.01)
        again = staged.filter(F.col("block_number") > newest[0]) if newest else staged
        if per_batch == 1:
            again.coalesce(batches).write.mode("append").parquet(source)
        else:
            _append(again, source, per_batch * -(-batches // 4))
    # One partition of state for each core: the staged batches are small.
    options = {"state_partitions": cores} | (job_options or {})
    job = EventIngestJob(spark, f"{root}/out", dims, **options)
    job.files_per_batch = per_batch
    query = job.start(tables.stream_decoded_logs(spark, source, max_files_per_trigger=per_batch),
                      trigger={"availableNow": True})
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the staged input was not consumed in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return job
