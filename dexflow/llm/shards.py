"""Sharding by Karmarkar-Karp differencing: near-equal bytes with groups of equal texts kept whole."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Bundles of groups for each shard, and the most large groups for each; the driver differences them all.
FAN = 2000
#: Rows that one task numbers.
BIN = 20_000


def difference(loads: list[tuple[int, ...]]) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions (tuples of k loads) into one by largest differencing.

    The two with the largest spread (largest minus smallest load) are added, the largest
    load of one to the smallest of the other, and go back, until one is left. Ties go to
    the earlier one. Returns, for each input, the slot that each of its slots went to, and the
    loads of those slots.
    """
    k = len(loads[0])
    nodes: list[tuple | None] = [None] * len(loads)
    heap = [(min(x) - max(x), i, x) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        down = sorted(range(k), key=lambda s: (-a[s], s))
        up = sorted(range(k), key=lambda s: (b[s], s))
        both = tuple(a[x] + b[y] for x, y in zip(down, up))
        nodes.append((i, down, j, up))
        heapq.heappush(heap, (min(both) - max(both), len(nodes) - 1, both))
    _, root, total = heap[0]
    place: dict[int, list[int]] = {root: list(range(k))}
    for n in range(len(nodes) - 1, len(loads) - 1, -1):
        i, down, j, up = nodes[n]
        here = place.pop(n)
        for child, order in ((i, down), (j, up)):
            to = [0] * k
            for slot, source in enumerate(order):
                to[source] = here[slot]
            place[child] = to
    return [place[i] for i in range(len(loads))], list(total)


def _bins(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``key, size`` groups to ``key, shard``, by one differencing run over large groups and bundles of the others.

    A group above a ``shards * FAN``-th of all bytes is an item by itself, so there are fewer than
    ``shards * FAN`` of them; the others are dealt by hash over as many bundles, each an item that goes to one
    shard undivided. The driver differences all items at once, whatever the number of groups, so that
    bundles make room for a group of any size.
    """
    spark = groups.sparkSession
    total = groups.agg(F.sum(F.col("size").cast("decimal(38,0)"))).first()[0]
    if total is None:
        return groups.select("key", F.lit(0).alias("shard")).limit(0)
    items = shards * FAN
    alone = F.col("size") > F.lit(int(total) // items)
    bundled = groups.where(~alone).select("key", "size", F.pmod(F.xxhash64("key"), F.lit(items)).cast("int").alias("bundle"))
    large = sorted((bytes(r["key"]), r["size"]) for r in groups.where(alone).collect())
    bundles = sorted(tuple(r) for r in bundled.groupBy("bundle").agg(F.sum("size")).collect())
    to, _ = difference([(int(x), *[0] * (shards - 1)) for _, x in large + bundles])
    slots = [t[0] for t in to]
    by_key = spark.createDataFrame([(k, t) for (k, _), t in zip(large, slots)], "key binary, shard int")
    by_bundle = spark.createDataFrame([(k, t) for (k, _), t in zip(bundles, slots[len(large):])], "bundle int, shard int")
    return bundled.join(F.broadcast(by_bundle), "bundle").select("key", "shard").unionByName(by_key)


def number_rows(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with a gapless number from 0 within each value of ``group``.

    Rows are numbered in bins of about ``BIN`` (by the hash of ``order``), and a bin starts where
    those before it end, so a group of any size is spread over many tasks.
    """
    rows = saved(rows, "unnumbered")
    bins = _bins(rows.count(), BIN)
    rows = rows.withColumn("_bin", F.pmod(F.xxhash64(*order), F.lit(bins)))
    sizes = rows.groupBy(group, "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_bin")
    sizes = saved(sizes.select(group, "_bin", (F.sum("_n").over(before) - F.col("_n")).alias("_from")), "bins")
    inside = F.row_number().over(Window.partitionBy(group, "_bin").orderBy(*order))
    return (rows.withColumn("_inside", inside).join(sizes, [group, "_bin"])
            .withColumn(name, F.col("_from") + F.col("_inside") - 1).drop("_bin", "_n", "_from", "_inside"))


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; 1 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shards of near-equal bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Documents with equal texts are one indivisible group and stay together; null texts are
    groups by their doc_id. The law is ``bytes``, so grown_shard is null. Slots number the
    rows of a shard from 0, by doc_id within hashed bins. Empty texts have size 1; ties and repeated
    rows are rows like others; the crc of a null text is null. Columns other
    than doc_id and text are ignored; an empty table gives no rows. Sizes are equal only as far as
    the groups allow: one group larger than a shard's share fills its shard alone.
    """
    absent = F.concat(F.lit("null text of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    key = F.unhex(F.coalesce(F.sha2("text", 256), F.md5(absent)))
    d = docs.select("doc_id", text_size(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32"), key.alias("key"))
    d = saved(d, "sizes")
    groups = saved(d.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    placed = saved(assign_groups(groups, shards), "shards")
    rows = d.join(placed, "key").select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "key")
    rows = number_rows(rows, "shard", ["doc_id", "key"], "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
