"""Conversation prefix trie: member intervals from a sparse table over the common prefixes of sorted conversations.

Conversations are cut into segments of ``SEGMENT`` turns, each with a hash of all turns
before it, and the segments are sorted over the cluster, so that those that begin alike lie side
by side. A task takes blocks of the order: from the common lengths of neighbours it builds a
sparse table of range minima, and every prefix of every row searches the left and the right end of its
members by halving steps in that table, without regard to any other prefix. A node whose
members reach an edge of their block may go on in the next; only such pieces are put together by a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Turns of a segment; rows of a block; depths that one running sum goes over.
SEGMENT, BLOCK, DEPTHS = 32, 4096, 1024
#: Characters of a text that deal rows of equal conversation, turn and role over tasks.
PREFIX = 64
NODE = ["depth", "n1", "n2"]


def turn_tokens(turns: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 0), ``token`` (stands for role and text) and ``size`` (code points of the text) of every turn.

    Turns are taken by turn, nulls first, ties by role and text; null roles and texts are empty. Rows without a
    conv_id are left out. The order is made over all tasks, so a long conversation is spread.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                    empty("role").alias("role"), empty("text").alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    token = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    rows = rows.repartitionByRange(*order, F.substring("text", 1, PREFIX)).sortWithinPartitions(*order, "text")

    def number(batches):
        task, conv, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
            place = np.arange(len(ids)) - np.repeat(starts, np.diff([*starts, len(ids)]))
            if conv == ids[0]:
                place[:starts[1] if len(starts) > 1 else None] += n
            conv, n = ids[-1], int(place[-1]) + 1
            yield pa.record_batch([batch.column("conv_id"), pa.array(np.full(len(ids), task)), pa.array(place), batch.column("token"), batch.column("size")],
                                  names=["conv_id", "task", "place", "token", "size"])

    numbered = saved(rows.select("conv_id", token.alias("token"), F.length("text").cast("long").alias("size")).mapInArrow(
        number, "conv_id long, task long, place long, token binary, size long"), "trie-turns")
    edges = (numbered.groupBy("task", "conv_id").agg((F.max("place") + 1).alias("n")).groupBy("task")
             .agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.max_by("n", "conv_id").alias("n"))
             .orderBy("task").collect())  # a row for each task of the sort
    carried, conv, seen = [], None, 0
    for e in edges:
        if e["first"] == conv:
            carried.append((e["task"], conv, seen))
        seen = e["n"] + (seen if e["last"] == conv else 0)
        conv = e["last"]
    offsets = turns.sparkSession.createDataFrame(carried, "task long, conv_id long, before long")
    return numbered.join(F.broadcast(offsets), ["task", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "token", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, token, size`` of rebuilt conversations, and a row of depth 0 for each; ``turns`` as ``turn_tokens`` gives them.

    The first h = crc32(conv_id) mod 6 turns are those of conversation conv_id - conv_id mod 100,
    or as many as it has; the conversation's own turns after its first h follow.
    """
    lent = turns.where("conv_id % 100 = 0 and place < 5").select(F.col("conv_id").alias("base"), "place", "token", "size")
    lengths = lent.groupBy("base").agg(F.count("*").alias("length"))
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    convs = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), head.alias("head"))
    convs = saved(convs.join(lengths, "base", "left").withColumn("borrowed", F.least("head", F.coalesce("length", F.lit(0)))).drop("length"),
                  "trie-heads")
    begin = convs.join(lent, "base").where("place < head").select("conv_id", (F.col("place") + 1).alias("depth"), "token", "size")
    own = turns.join(convs, "conv_id").where("place >= head").select(
        "conv_id", (F.col("borrowed") + F.col("place") - F.col("head") + 1).alias("depth"), "token", "size")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("token"), F.lit(0).cast("long").alias("size"))
    return begin.unionByName(own).unionByName(root)


def segments(sequences: DataFrame) -> DataFrame:
    """A row for each segment of each conversation: ``conv_id, segment``, the hash of the turns before it (``p1, p2``), its ``turns``, ``last``.

    The hash of a sequence is the exclusive or of the hashes of (depth, token). ``turns`` has
    the hashes and sizes, by depth; ``last`` says that the conversation ends here.
    """
    mark: Column = F.col("depth") > 0
    hashed = sequences.select(
        "conv_id", F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / SEGMENT).alias("segment"),
        *[F.when(mark, F.xxhash64(F.lit(i), "depth", "token")).otherwise(0).alias(f"x{i}") for i in (1, 2)], "depth", "size")
    found = hashed.groupBy("conv_id", "segment").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
        F.sort_array(F.collect_list(F.when(mark, F.struct("depth", "x1", "x2", "size")))).alias("turns"))  # at most SEGMENT
    by = Window.partitionBy("conv_id").orderBy("segment")  # over segments, not turns
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumns({**{f"p{i}": F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0)) for i in (1, 2)},
                              "last": F.lead("segment").over(by).isNull()})


BLOCKS = ("g long, segment array<long>, p1 array<long>, p2 array<long>, conv_id array<long>, length array<int>, x binary, size binary")


def blocks(rows: DataFrame) -> DataFrame:
    """The sorted segments ``rows``, ``BLOCK`` to a row; ``x`` holds their turns' hashes (two numbers each), ``size`` the sizes."""

    def keyed(batches):
        for batch in batches:
            turns = batch.column("turns")
            flat = turns.flatten()
            x = np.stack([pc.struct_field(flat, f"x{i}").to_numpy() for i in (1, 2)], 1)
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(turns).to_numpy())])
            sizes = pc.struct_field(flat, "size").to_numpy()
            out = [[v[a:b].tobytes() for a, b in zip(at, at[1:])] for v in (x, sizes)]
            yield pa.record_batch([*(batch.column(c) for c in ("segment", "p1", "p2", "conv_id")), *[pa.array(v, pa.binary()) for v in out]],
                                  names=["segment", "p1", "p2", "conv_id", "x", "size"])

    def pack(batches):
        made, held = TaskContext.get().partitionId() << 33, None

        def packed(table):
            nonlocal made
            made += 1
            lists = [pa.array([table.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("segment", "p1", "p2", "conv_id")]
            x = table.column("x").to_pylist()
            return pa.record_batch([pa.array([made], pa.int64()), *lists, pa.array([[len(v) // 16 for v in x]], pa.list_(pa.int32())),
                                    pa.array([b"".join(x)]), pa.array([b"".join(table.column("size").to_pylist())])],
                                   names=["g", "segment", "p1", "p2", "conv_id", "length", "x", "size"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            full = len(table) // BLOCK * BLOCK
            for i in range(0, full, BLOCK):
                yield packed(table.slice(i, BLOCK))
            held = table.slice(full)
        if held is not None and len(held):
            yield packed(held)

    order = ["segment", "p1", "p2", "x", "conv_id"]
    rows = rows.select("segment", "p1", "p2", "conv_id", "turns").mapInArrow(keyed, "segment long, p1 long, p2 long, conv_id long, x binary, size binary")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, BLOCKS)


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """``table[k][i]`` is the least of values[i : i + 2**k]."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def range_least(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first : last + 1] for each pair of ends."""
    level = np.frexp(last - first + 1)[1] - 1
    out = np.empty(len(first), table[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - 2 ** int(k) + 1])
    return out


def extents(common: np.ndarray, rows: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the prefix of ``depth`` turns of each of ``rows``, the first and the last row that begin with it.

    ``common[i]`` is how many turns rows i - 1 and i share. Each search takes the steps 2**k, from the
    largest on, over which the least of ``common`` is ``depth`` or more.
    """
    table, left, right = sparse_table(common), rows.copy(), rows.copy()
    for k in range(len(table) - 1, -1, -1):
        step, least = 2 ** k, table[k]
        to = right + step
        ok = (to < len(common)) & (least[np.minimum(right + 1, len(least) - 1)] >= depth)
        right = np.where(ok, to, right)
        to = left - step
        ok = (to >= 0) & (least[np.maximum(to + 1, 0)] >= depth)
        left = np.where(ok, to, left)
    return left, right


class Block:
    """The rows of a block, and the nodes that they make."""

    def __init__(self, row: dict):
        self.segment, self.p1, self.p2, self.conv = (np.array(row[c], np.int64) for c in ("segment", "p1", "p2", "conv_id"))
        self.length = np.array(row["length"], np.int64)
        n = len(self.length)
        starts = np.cumsum(self.length) - self.length
        column = np.arange(self.length.sum()) - np.repeat(starts, self.length)
        line = np.repeat(np.arange(n), self.length)
        self.x, self.size = np.zeros((n, SEGMENT + 1, 2), np.int64), np.zeros((n, SEGMENT + 1), np.int64)
        self.x[line, column + 1] = np.frombuffer(row["x"], np.int64).reshape(-1, 2)
        self.size[line, column + 1] = np.frombuffer(row["size"], np.int64)
        alike = (self.x[1:] == self.x[:-1]).all(axis=2)[:, 1:]
        alike &= np.arange(SEGMENT) < np.minimum(self.length[1:], self.length[:-1])[:, None]
        shared = np.cumprod(alike, axis=1).sum(axis=1)
        group = (self.segment[1:] == self.segment[:-1]) & (self.p1[1:] == self.p1[:-1]) & (self.p2[1:] == self.p2[:-1])
        common = np.concatenate([[-1], np.where(group, shared, -1)])
        self.x[:, 0, 0], self.x[:, 0, 1] = self.p1, self.p2
        self.prefix = np.bitwise_xor.accumulate(self.x, axis=1)
        # Every prefix of every row; the empty one is a node, the root, only before the first segment.
        rows = np.repeat(np.arange(n), self.length + (self.segment == 0))
        begins = np.cumsum(self.length + (self.segment == 0)) - (self.length + (self.segment == 0))
        depth = np.arange(len(rows)) - begins[rows] + (self.segment[rows] != 0)
        left, right = extents(common, rows, depth)
        own = left == rows  # each node once: by its first row
        self.left, self.right, self.depth = left[own], right[own], depth[own]

    def keys(self) -> dict[str, np.ndarray]:
        at, d = self.left, self.depth
        return {"depth": self.segment[at] * SEGMENT + d, "n1": self.prefix[at, d, 0], "n2": self.prefix[at, d, 1],
                "open": (self.left == 0) | (self.right == len(self.length) - 1)}

    def nodes(self) -> dict[str, np.ndarray]:
        at, up = self.left, np.maximum(self.depth - 1, 0)
        return self.keys() | {"q1": self.prefix[at, up, 0], "q2": self.prefix[at, up, 1], "conv_id": range_least(sparse_table(self.conv), at, self.right),
                              "n_convs": self.right - at + 1, "size": self.size[at, self.depth]}

    def sums(self, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The sum of each of ``weights``, a number per row, over the members of the nodes."""
        out = self.keys()
        for name, w in weights.items():
            total = np.concatenate([[0], np.cumsum(w)])
            out[name] = total[self.right + 1] - total[self.left]
        return out


def batch_of(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(v) for v in columns.values()], names=list(columns))


def merged(pieces: DataFrame, **how: Column) -> DataFrame:
    """Nodes from the ``pieces`` of the blocks: those at the edge of a block are put together by ``how``."""
    names = [*NODE, *how]
    whole = pieces.where("not open").select(*names)
    return whole.unionByName(pieces.where("open").groupBy(*NODE).agg(*[c.alias(n) for n, c in how.items()]).select(*names))


def nodes_of(blocked: DataFrame) -> DataFrame:
    """``depth, n1, n2`` (the node), ``q1, q2`` (its parent, one turn less), conv_id (smallest member), n_convs, size (of the last text)."""

    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield batch_of(Block(row).nodes())

    found = blocked.mapInArrow(find, "depth long, n1 long, n2 long, open boolean, q1 long, q2 long, conv_id long, n_convs long, size long")
    return merged(found, q1=F.max("q1"), q2=F.max("q2"), conv_id=F.min("conv_id"), n_convs=F.sum("n_convs"), size=F.max("size"))


def summed(blocked: DataFrame, weights: DataFrame, *names: str) -> DataFrame:
    """For each node the sums of the columns ``names`` of ``weights`` (conv_id, ...) over its members."""
    spots = blocked.select("g", F.posexplode("conv_id").alias("at", "conv_id")).join(weights, "conv_id")
    spots = spots.groupBy("g").agg(F.collect_list(F.struct("at", *names)).alias("found")).withColumnRenamed("g", "of")  # at most BLOCK

    def add(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = np.array([f["at"] for f in row["found"] or []], np.int64)
                w = {n: np.zeros(len(row["length"]), np.int64) for n in names}
                for n in names:
                    w[n][at] = [f[n] for f in row["found"] or []]
                yield batch_of(Block(row).sums(w))

    joined = blocked.join(spots, F.col("g") == F.col("of"), "left").drop("of")
    found = joined.mapInArrow(add, "depth long, n1 long, n2 long, open boolean, " + ", ".join(f"{n} long" for n in names))
    return merged(found, **{n: F.sum(n) for n in names})


def before_own(nodes: DataFrame) -> DataFrame:
    """``NODE, before``: the ``weight`` of the nodes above that have the same conv_id, for a path of any length block by block."""
    rows = nodes.select(*NODE, "conv_id", "weight", F.floor(F.col("depth") / DEPTHS).alias("part"))
    totals = rows.groupBy("conv_id", "part").agg(F.sum("weight").alias("total"))
    parts = Window.partitionBy("conv_id").orderBy("part")  # over parts, not nodes
    totals = totals.select("conv_id", "part", (F.sum("total").over(parts) - F.col("total")).alias("parts_before"))
    inner = F.sum("weight").over(Window.partitionBy("conv_id", "part").orderBy("depth")) - F.col("weight")
    return rows.withColumn("inner", inner).join(totals, ["conv_id", "part"]).select(*NODE, (F.col("inner") + F.col("parts_before")).alias("before"))


def prefix_trie(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of ``sequences`` and the conversations that end in them.

    ``sequences`` has conv_id, depth, token and size: a row for each turn, depths without gaps from 1, and
    one of depth 0 for each conversation, also for those without turns. Equal tokens are
    equal turns. Nodes are ``depth, n1, n2`` (the node), conv_id (its smallest member),
    parent_conv_id (null for the root), n_convs, n_children, n_leaves and saved_tokens (over
    its subtree, the sizes that all but one of its members share); ends have ``depth, n1, n2, conv_id``.

    Every node belongs to its smallest member. So a subtree has what belongs to its members, without
    the nodes above it that belong to the top's own: its sums are one more search of intervals, with
    the members' weights. No conversations give no nodes.
    """
    rows = saved(segments(sequences), "trie-segments")
    blocked = saved(blocks(rows), "trie-blocks")
    nodes = saved(nodes_of(blocked), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("n1"), F.col("q2").alias("n2")).agg(
        F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "weight": (F.col("n_convs") - 1) * F.col("size")})
    nodes = saved(nodes, "trie-counted")
    own = nodes.groupBy("conv_id").agg(F.sum("weight").alias("weight"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    sums = summed(blocked, own, "weight", "leaves").withColumnsRenamed({"weight": "below", "leaves": "n_leaves"})
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(sums, NODE).join(before_own(nodes), NODE)
    full = full.join(parents.hint("merge"), ["depth", "q1", "q2"], "left")  # a parent may have very many children: split by size
    full = full.withColumn("saved_tokens", F.col("below") - F.col("before"))
    ends = rows.where("last").select("conv_id", (F.col("segment") * SEGMENT + F.size("turns")).alias("depth"),
                                     F.col("p1").bitwiseXOR(F.col("x1")).alias("n1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("n2"))
    return full.select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), ends


def ends_digest(ends: DataFrame) -> DataFrame:
    """``NODE, ends_sha256``: SHA-256 of the ids that end in a node, ascending, joined by commas.

    The ids of one node are a stream through one task, as a SHA-256 takes its bytes one after the other; nothing is held.
    """

    def digest(batches):
        node, sha, done = None, None, []
        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if key == node:
                    sha.update(b",%d" % conv)
                else:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(b"%d" % conv)
            if done:
                yield pa.record_batch([pa.array(c) for c in zip(*done)], names=[*NODE, "ends_sha256"])
                done = []
        if node is not None:
            yield pa.record_batch([pa.array([v]) for v in (*node, sha.hexdigest())], names=[*NODE, "ends_sha256"])

    rows = ends.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return rows.mapInArrow(digest, "depth long, n1 long, n2 long, ends_sha256 string")


def trie_report(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text; see ``turn_tokens`` for nulls and ties, ``rebuilt``
    for what conversations are made of and ``prefix_trie`` for the nodes. Repeated rows are turns of their own.
    Other columns are ignored; an empty table, or one without a conv_id, gives no rows.
    """
    nodes, ends = prefix_trie(rebuilt(turn_tokens(turns)))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.join(ends_digest(ends), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))
