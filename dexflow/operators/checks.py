"""Data-quality checks over the event table and its copies (O-48..O-51)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..plans.sizing import materialize_dimension
from ..sources import dims


def _summary_aggs(approx: bool = False):
    distinct_ids = F.approx_count_distinct("id") if approx else F.count_distinct("id")
    return [
        F.count(F.lit(1)).alias("total_rows"),
        distinct_ids.alias("unique_ids"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
        *[F.count_if(F.col("protocol") == p).alias(f"{p.replace('-', '_')}_events") for p in dims.PROTOCOLS],
    ]


def integrity_summary(events: DataFrame, table_name: str = "protocol_events", approx: bool = False) -> DataFrame:
    """O-48: rows, distinct ids, time range (ms and ISO text), rows per protocol. One global aggregate."""
    out = events.agg(*_summary_aggs(approx))
    return out.select(F.lit(table_name).alias("table_name"), "*",
                      X.iso_millis("min_timestamp").alias("min_time_iso"),
                      X.iso_millis("max_timestamp").alias("max_time_iso"))


def label_copies(copies: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Stack several copies of the table with a ``copy`` label (one scan each, one plan)."""
    cols = columns or ["id", "protocol", "timestamp"]
    parts = [df.select(F.lit(name).alias("copy"), *cols) for name, df in copies.items()]
    return reduce(DataFrame.unionByName, parts)


def copy_counts(copies: dict[str, DataFrame], approx: bool = False) -> DataFrame:
    """O-49: the integrity summary per copy. Grouped by copy, so each copy is aggregated in parallel."""
    return label_copies(copies).groupBy("copy").agg(*_summary_aggs(approx))


def copy_verdict(copies: dict[str, DataFrame]) -> DataFrame:
    """O-50: do all copies have one row count? Plus the total over copies and an order-free checksum.

    The checksum is the sum and the exclusive or of a hash of every id: equal multisets of ids give equal
    checksums without sorting or shuffling rows, and an id that stands twice does not cancel itself.
    """
    stacked = label_copies(copies, ["id"])
    per_copy = stacked.groupBy("copy").agg(F.count(F.lit(1)).alias("n"),
                                           F.struct(F.sum(F.xxhash64("id").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("id"))).alias("checksum"))
    return per_copy.agg(
        F.count(F.lit(1)).alias("copies"),
        (F.count_distinct("n") == 1).alias("consistent"),
        F.sum("n").alias("total_rows"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        (F.count_distinct("checksum") == 1).alias("same_ids"),
    )


#: Hexadecimal digits of the id's MD5 that name the bucket of a row: 16 buckets a month for each.
BUCKET_DIGITS = 1


def _digest() -> list[Column]:
    """What equal multisets of rows have in common: their number, and the sum and exclusive or of two hashes of whole rows."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.col("h1").cast("decimal(38,0)")).alias("s"), F.bit_xor("h2").alias("x")]


def hashed_rows(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``id, event_month, bucket, h1, h2``: two hashes of every column's value, null or not."""
    columns = columns or [c for c in events.columns if c not in ("created_at", "batch_id")]
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return events.select("id", "event_month", F.substring(F.md5("id"), 1, BUCKET_DIGITS).alias("bucket"),
                         *[F.xxhash64(F.lit(i), nulls, *columns).alias(f"h{i}") for i in (1, 2)])


def copy_differences(copies: dict[str, DataFrame], base: str) -> DataFrame:
    """O-50: where copies differ from the copy ``base``: copy, event_month, bucket, rows, base_rows.

    One pass over each copy writes its digests per (month, bucket), a few rows, and the digests are compared. A changed
    value, a missing row and a row that stands twice all show.
    """
    level = ["event_month", "bucket"]
    rows = reduce(DataFrame.unionByName, [hashed_rows(df).withColumn("copy", F.lit(name)) for name, df in copies.items()])
    digests = materialize_dimension(rows.groupBy("copy", *level).agg(*_digest()))
    of_base = digests.filter(F.col("copy") == base).drop("copy").withColumnsRenamed({"rows": "base_rows", "s": "base_s", "x": "base_x"})
    keys = reduce(DataFrame.unionByName, [digests.select(*level).distinct().withColumn("copy", F.lit(c)) for c in copies if c != base])
    found = keys.join(digests, ["copy", *level], "left").join(of_base, level, "left")
    same = F.col("s").eqNullSafe(F.col("base_s")) & F.col("x").eqNullSafe(F.col("base_x")) & F.col("rows").eqNullSafe(F.col("base_rows"))
    return found.filter(~same).select("copy", *level, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("base_rows", F.lit(0)).alias("base_rows"))


def differing_ids(copy: DataFrame, base: DataFrame, differences: DataFrame) -> DataFrame:
    """The ids in the ``differences`` (event_month, bucket) of one copy whose rows are not those of ``base``: id, rows, base_rows."""
    places = differences.select("event_month", "bucket").distinct()
    sides = [hashed_rows(df).join(places, ["event_month", "bucket"], "left_semi").groupBy("id").agg(*_digest()) for df in (copy, base)]
    b = sides[1].withColumnsRenamed({"rows": "base_rows", "s": "base_s", "x": "base_x"})
    joined = sides[0].join(b, "id", "full")
    same = F.col("s").eqNullSafe(F.col("base_s")) & F.col("x").eqNullSafe(F.col("base_x")) & F.col("rows").eqNullSafe(F.col("base_rows"))
    return joined.filter(~same).select("id", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("base_rows", F.lit(0)).alias("base_rows"))


def duplicate_ids(events: DataFrame) -> DataFrame:
    """O-51: ids stored more than once, with their multiplicity ("unique ids should match row count")."""
    return events.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def id_uniqueness(events: DataFrame) -> DataFrame:
    """O-51 summary: rows, distinct ids, and the gap between them."""
    return events.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("id").alias("unique_ids")) \
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_ids"))
