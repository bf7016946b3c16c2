"""Size checks in front of broadcast joins.

A dimension that grows with the data (the discovered pools) is broadcast only
after it has been written as a Parquet table under the shared
``spark.checkpoint.dir`` (one job, which also counts the rows as it writes them; cuts the
lineage, survives executor loss) and its count is under a row limit. Above the limit the join stays a shuffle join,
which AQE sizes and splits on skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path

# Rows of a dimension allowed into a broadcast. Pool rows are ~300 bytes, so
# the default keeps a broadcast under ~60 MB. Override per session with
# spark.conf.set("dexflow.maxBroadcastRows", ...).
DEFAULT_MAX_BROADCAST_ROWS = 200_000


def max_broadcast_rows(spark) -> int:
    return int(spark.conf.get("dexflow.maxBroadcastRows", str(DEFAULT_MAX_BROADCAST_ROWS)))


def materialize_dimension(dim: DataFrame, limit: int | None = None, write: bool = True) -> DataFrame:
    """Broadcast ``dim`` only when its counted size is under ``limit``.

    With ``write`` the dimension is first written as a table (cuts its lineage,
    so the count and the join read the same rows). Without it (the dimension
    already comes from a written table, as in the streaming pool registry)
    only the count runs.
    """
    spark = dim.sparkSession
    if dim.isStreaming:
        return dim
    limit = max_broadcast_rows(spark) if limit is None else limit
    if write:
        path, seen = scratch_path(spark, "dexflow-dims"), Observation()
        dim.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        rows, dim = seen.get["rows"], spark.read.schema(dim.schema).parquet(path)
    else:
        rows = dim.count()
    return F.broadcast(dim) if rows <= limit else dim
