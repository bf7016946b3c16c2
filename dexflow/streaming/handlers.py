"""Handlers of a batch's rows with a commit record each (O-64).

A handler that has been called for a batch leaves a record of (handler, batch). When the batch
runs again, because the job ended before the batch was committed, handlers with a record are not called
again. One that failed half-way has none and is called again with the same batch id and rows, so
a sink that overwrites by batch id gets every row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import files

Handler = Callable[[DataFrame, int], None]

#: Records kept per handler; only the last batch can run again.
KEPT = 10


class HandlerLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _record(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/batch_{batch_id}"

    def call(self, name: str, fn: Handler, rows: DataFrame, batch_id: int) -> bool:
        """Call ``fn(rows, batch_id)`` unless that has been done; says whether it was called."""
        if files.exists(self.spark, self._record(name, batch_id)):
            return False
        fn(rows, batch_id)
        files.touch(self.spark, self._record(name, batch_id))
        files.delete(self.spark, self._record(name, batch_id - KEPT))
        return True
