"""Logs that wait for the registration of their pool (O-61), kept so that a batch reads only what it may release.

Rows are dealt into buckets by their pool's key. A batch appends what it could not match to
``deltas/batch_id=B/bucket=K``. Every ``compact_every`` batches, a batch first writes the snapshot
``snapshots/as_of=B/bucket=K``: all rows of earlier batches that the registry of then still does not match. What it
matches has been released, so the registry is the release marker, and released rows are dropped.
A batch that registers pools reads the newest snapshot and the deltas after it, of the buckets
of those pools alone. So its files do not grow with the batches, and its rows only with what waits.

A batch may run again until the next one begins. It then finds what it found the first time: a
snapshot is made of an earlier one and of deltas that stay until one more snapshot has been made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich
from ..sources import files


class Quarantine:
    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int = 32, compact_every: int = 20):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.buckets, self.compact_every = buckets, compact_every

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, path: str, by: list[str], replace: str) -> None:
        (rows.withColumn("bucket", self._bucket(F.col("pool_key"))).hint("rebalance", "bucket").sortWithinPartitions("bucket", "pool_key")
             .write.mode("overwrite").option("partitionOverwriteMode", replace).option("compression", "zstd").partitionBy(*by).parquet(path))

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the rows that batch ``batch_id`` could not match; a repeated batch replaces its own."""
        self._write(rows.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")), f"{self.path}/deltas", ["batch_id", "bucket"], "dynamic")

    def _snapshots(self, before: int) -> list[int]:
        found = [int(v) for v in files.values(self.spark, f"{self.path}/snapshots", "as_of")]
        return sorted(s for s in found if s < before and files.exists(self.spark, f"{self.path}/snapshots/as_of={s}/_SUCCESS"))

    def _folders(self, snapshot: int | None, before: int) -> list[str]:
        deltas = [int(v) for v in files.values(self.spark, f"{self.path}/deltas", "batch_id")]
        out = [f"{self.path}/deltas/batch_id={b}" for b in sorted(deltas) if (snapshot is None or b >= snapshot) and b < before]
        return out if snapshot is None else [f"{self.path}/snapshots/as_of={snapshot}", *out]

    def _read(self, folders: list[str], buckets: list[int] | None = None) -> DataFrame:
        if buckets is not None:
            folders = [f"{f}/bucket={b}" for f in folders for b in sorted(buckets) if files.exists(self.spark, f"{f}/bucket={b}")]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)

    def held(self, batch_id: int, pools: DataFrame) -> DataFrame:
        """The rows that wait before ``batch_id``, of the buckets that hold the keys of ``pools``."""
        buckets = [r[0] for r in pools.select(self._bucket(F.col("pool_key"))).distinct().collect()]  # at most self.buckets
        newest = max(self._snapshots(batch_id + 1), default=None)
        return self._read(self._folders(newest, batch_id), buckets)

    def compact_if_due(self, batch_id: int, registry: DataFrame | None) -> bool:
        """At the start of a batch: a new snapshot if the last is ``compact_every`` batches old; ``registry`` as of before the batch."""
        earlier = self._snapshots(batch_id)
        last = max(earlier, default=None)
        if registry is None or batch_id - (last or 0) < self.compact_every:
            return False
        waiting = self._read(self._folders(last, batch_id))
        self._write(enrich.split_by_pools(waiting, registry, matched=False), f"{self.path}/snapshots/as_of={batch_id}", ["bucket"], "static")  # leaves _SUCCESS
        # Only this batch can run again, and it needs the last snapshot and what came after.
        for s in earlier[:-1]:
            files.delete(self.spark, f"{self.path}/snapshots/as_of={s}")
        for b in files.values(self.spark, f"{self.path}/deltas", "batch_id"):
            if last is not None and int(b) < last:
                files.delete(self.spark, f"{self.path}/deltas/batch_id={b}")
        return True
