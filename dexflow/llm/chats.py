"""Chat formatting: collapse cumulative snapshots of logged conversations, then render what is left.

Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Turns are numbered and hashed block by block of this many turn numbers, so that
#: one conversation that holds a large share of all rows is not one task.
BLOCK = 1024


def turn_hash(seed: int) -> Column:
    """Hash of a turn's place, role and text; null differs from empty."""
    return F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Each turn with its place (from 1), the length of its conversation, and the rolling hash of the turns up to it.

    The rolling hash is the running exclusive or of the hashes of (place, role,
    text), 128 bits wide (p1, p2). It depends on the order through the places, and
    blocks of a conversation can be hashed apart and put together afterwards.
    """
    t = turns.select("conv_id", "turn", "role", "text",
                     F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK).alias("block"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    in_block = Window.partitionBy("conv_id", "block")
    sizes = t.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    blocks = Window.partitionBy("conv_id").orderBy("block")
    sizes = sizes.select(
        "conv_id", "block", (F.sum("n").over(blocks) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("turns"))
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["block"] == b["block"])
    t = t.withColumn("rank", F.row_number().over(in_block.orderBy(*order)))
    t = t.join(sizes, same(t, sizes)).select(t["*"], "before", "turns")
    t = (t.withColumn("place", F.col("before") + F.col("rank"))
         .withColumns({"e1": turn_hash(1), "e2": turn_hash(2)}))
    t = saved(t.select("conv_id", "block", "place", "turns", "role", "text", "e1", "e2"), "turns")
    totals = t.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"))
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(earlier), F.lit(0)).alias(f"b{i}")
                                                 for i in (1, 2)])
    w = in_block.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({"x1": F.bit_xor("e1").over(w), "x2": F.bit_xor("e2").over(w)})
    return t.join(totals, same(t, totals)).select(
        t["conv_id"], "place", "turns", "role", "text",
        F.col("x1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("b2")).alias("p2"))


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """The turns of the maximal conversations: those that are no proper prefix of a longer one.

    Of conversations with the same turns the one with the smallest conv_id stays; ``copies``
    says how many there were. Anti-joins work on one row per distinct prefix, so a
    first turn that a third of all conversations share is one row.
    """
    t = saved(prefix_hashes(turns), "prefixes")
    whole = (t.where("place = turns").groupBy("turns", "p1", "p2")
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    inner = t.where("place < turns").select(F.col("place").alias("turns"), "p1", "p2").distinct()
    kept = saved(whole.join(inner, ["turns", "p1", "p2"], "left_anti"), "maximal")
    kept = kept.select(F.col("conv_id").alias("kept_id"), "copies")
    return t.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))).select(
        "conv_id", "turns", "copies", "place", "role", "text")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, copies, rendered.

    Turns are ordered by turn, role and text (nulls first), so gaps and ties in
    the numbers do no harm; a repeated row counts as one more turn. Rendered is
    ``<|role|>``, a line break, the text, ``<|end|>`` and a line break, for each
    turn; a null role reads ``unknown``, a null text is empty. Rows without a conv_id are
    one conversation whose id is null. Other columns of the table are ignored; an empty
    table gives no rows. A rendered conversation is one value, so the last
    grouping needs memory for the longest conversation.
    """
    one = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"),
                   F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    t = collapse_snapshots(turns).select("conv_id", "turns", "copies", F.struct("place", one.alias("s")).alias("t"))
    return (t.groupBy("conv_id", "turns", "copies").agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .select("conv_id", F.col("turns").alias("n_turns"), "copies",
                    F.array_join("ts.s", "").alias("rendered")))
