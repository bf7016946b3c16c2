"""MinHash near-dedup: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import components, saved
from .words import U

#: A signature has CHUNKS * SLOTS values of 16 bits. Two signatures that differ in less
#: than CHUNKS * (ERRORS + 1) values have, by the pigeonhole principle, a chunk with at most
#: ERRORS differing values: leaving out each choice of ERRORS values enumerates them.
CHUNKS, SLOTS, ERRORS = 10, 4, 1
VALUES = CHUNKS * SLOTS
#: The most values that may differ: 22 of 40. Every pair within 19 shares a chunk key; one at 20 to 22 does unless
#: all its errors are spread over the chunks by two and three. Sets of similarity 0.8 differ in 8 values on
#: average, in 20 or more with a probability of 2.2e-5 (hardly any of which are without a shared key), in more than 22 of 2.6e-7.
DISTANCE = CHUNKS * (ERRORS + 1) + 2
#: Members of a group that a task holds to compare others with, and about how many others it compares with them.
BLOCK, ASKERS = 256, 1024

SIGNATURE = "doc_id long, n long, f1 long, f2 long, signature binary"
SIGNATURE_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("signature", pa.binary())])


class Shingles:
    """Shingle sets of the texts of a batch, as sorted arrays of 64-bit hashes."""

    def __init__(self, width: int):
        self.width, self.by_word = width, words.Rolling(words.WORD_STEP)

    def sets(self, data: np.ndarray, offsets: np.ndarray):
        w = words.Words(data, offsets, lower=True)
        h = w.hashes()
        wide = words.mix(words.window_hashes(h, self.width, self.by_word))
        for i in range(len(offsets) - 1):
            s, e = w.first[i], w.first[i + 1]
            if e - s >= self.width:
                yield np.unique(wide[s:e - self.width + 1])
            elif e > s:  # fewer words: the whole sequence is one shingle
                yield words.mix(words.window_hashes(h[s:e], e - s, self.by_word) + U(e - s))
            else:
                yield np.empty(0, U)

    def of_text(self, text: bytes) -> np.ndarray:
        return next(self.sets(np.frombuffer(text, np.uint8), np.array([0, len(text)])))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    if not len(s):
        return 0, 0
    with np.errstate(over="ignore"):
        a, b = np.add.reduce(words.mix(s)), np.bitwise_xor.reduce(words.mix(s ^ U(0x2545F4914F6CDD1D)))
    return int(a.view(np.int64)), int(b.view(np.int64))


def signature(s: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The b-bit MinHash values of a set: 16 bits of each minimum."""
    least = np.full(len(seeds), ~U(0), U)
    for i in range(0, len(s), 4096):
        part = (s[i:i + 4096, None] ^ seeds) * (seeds | U(1))
        np.minimum(least, part.min(axis=0), out=least)
    return words.mix(least).astype(np.uint16)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, set size, fingerprint and signature of every text's shingle set."""

    def sign(batches):
        seeds, shingles = words.mix(np.arange(1, VALUES + 1, dtype=U)), Shingles(width)
        for batch, data, offsets in words.pieces(batches):
            rows = [(len(s), *fingerprint(s), signature(s, seeds).tobytes()) for s in shingles.sets(data, offsets)]
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(zip(*rows), list(SIGNATURE_ARROW)[1:])]],
                                  schema=SIGNATURE_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, SIGNATURE)


def chunk_keys(classes: DataFrame, *carried: str) -> DataFrame:
    """``key, cid`` and the ``carried`` columns (longs): for each chunk of a signature, a key for every choice of ``ERRORS`` values left out."""
    choices = list(itertools.combinations(range(SLOTS), SLOTS - ERRORS))
    names = ["cid", *carried]

    def split(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(n, CHUNKS, SLOTS).astype(U)
            keys = np.empty((n, CHUNKS, len(choices)), U)
            for k, choice in enumerate(choices):
                x = np.zeros((n, CHUNKS), U)
                for c in choice:
                    x = x * U(65536) + values[:, :, c]
                keys[:, :, k] = words.mix(words.mix(x) ^ words.mix((np.arange(CHUNKS, dtype=U) * U(len(choices)) + U(k + 1)) << U(20)))
            others = [pa.array(np.repeat(batch.column(c).to_numpy(), CHUNKS * len(choices))) for c in names]
            yield pa.record_batch([pa.array(keys.reshape(-1).view(np.int64)), *others], names=["key", *names])

    return classes.select(*names, "signature").mapInArrow(split, "key long, " + ", ".join(f"{c} long" for c in names))


def close(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures differ in at most DISTANCE values and sizes allow the similarity (last axis: values)."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    return ((a != b).sum(axis=-1) <= DISTANCE) & (100 * small >= percent * large)


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def signature_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose signatures are close."""

    def keep(batches):
        for batch in batches:
            get = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, VALUES)
            num = lambda c: batch.column(c).to_numpy()
            use = close(get("sa"), get("sb"), num("na"), num("nb"), percent)
            yield pa.record_batch([pa.array(num("a")[use]), pa.array(num("b")[use])], schema=PAIR)

    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("signature").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(keep, "a long, b long")


def class_texts(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``cid, text`` of the classes in ``pairs``. Only these texts leave the shuffle of all texts."""
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = saved(classes.join(wanted, "cid").select("cid", F.col("first").alias("doc_id"), "f1", "f2"), "wanted")

    def of_class(batches):  # a doc_id may stand for several texts
        shingles = Shingles(width)
        for batch, data, offsets in words.pieces(batches):
            rows = [i for i, s in enumerate(shingles.sets(data, offsets))
                    if fingerprint(s) == (batch.column("f1")[i].as_py(), batch.column("f2")[i].as_py())]
            yield batch.select(["cid", "text"]).take(pa.array(rows, pa.int64()))

    # Ids and texts both grow with the input, so the join is the same at every size: never a broadcast.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id")
    return saved(texts.select("cid", "text", "f1", "f2").mapInArrow(of_class, "cid long, text string"), "class-texts")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets have 100 * intersection >= percent * union."""

    def check(batches):
        shingles, held = Shingles(width), {}

        def set_of(cid, text):
            if cid not in held:
                if len(held) >= 64:
                    held.pop(next(iter(held)))
                held[cid] = shingles.of_text(text.as_buffer().to_pybytes())
            return held[cid]

        for batch in batches:
            ids, out = [batch.column(c).to_pylist() for c in ("a", "b")], []
            for i, (a, b) in enumerate(zip(*ids)):
                x, y = set_of(a, batch.column("ta")[i]), set_of(b, batch.column("tb")[i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((a, b))
            yield pa.record_batch([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], schema=PAIR)

    side = lambda x: texts.select(F.col("cid").alias(x), F.col("text").alias(f"t{x}")).hint("merge")
    return saved(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long"), "links")


def homes(rows: DataFrame, group: str, label: str) -> DataFrame:
    """``group, home, blocks, strips`` of the groups with several labels: home is the most common one.

    ``blocks`` is the number of blocks of members, ``strips`` that of the rows outside the home.
    """
    sizes = rows.groupBy(group, label).agg(F.count("*").alias("size"))
    found = sizes.groupBy(group).agg(F.max_by(label, F.struct("size", label)).alias("home"), F.sum("size").alias("rows"),
                                     F.max("size").alias("at_home"), F.count("*").alias("labels"))
    return saved(found.where("labels > 1").select(group, "home", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"),
                                                  F.ceil((F.col("rows") - F.col("at_home")) / ASKERS).cast("int").alias("strips")), "homes")


def dealt(rows: DataFrame, homes_: DataFrame, group: str, label: str) -> DataFrame:
    """``rows`` of groups with several labels, dealt so that rows of different labels meet.

    Members are dealt over the group's blocks, rows outside the home label (``out``) also over
    its strips. Every pair of a block and a strip is a task's work: a member goes to its block with every strip,
    a row outside the home asks in its strip with every block; rows of the home label never need
    each other. So a group of any size is many tasks of bounded size.
    """
    rows = rows.join(homes_, group)
    dealt_to = lambda count, salt: F.pmod(F.xxhash64("cid", group, F.lit(salt)), F.col(count)).cast("int")
    rows = rows.withColumns({"out": F.col(label) != F.col("home"), "own": dealt_to("blocks", 0), "lane": dealt_to("strips", 1)})
    place = F.expr("""concat(transform(sequence(0, strips - 1), s -> struct(own as block, s as strip, false as asks)), case when out
        then transform(sequence(0, blocks - 1), b -> struct(b as block, lane as strip, true as asks))
        else cast(array() as array<struct<block: int, strip: int, asks: boolean>>) end)""")
    kept = [c for c in rows.columns if c not in ("home", "blocks", "strips", "own", "lane")]
    return rows.withColumn("place", F.explode(place)).select(*kept, "place.block", "place.strip", "place.asks")


def meetings(rows: DataFrame, group: str, meet) -> DataFrame:
    """Pairs that ``meet`` finds between the members of each block and the askers of each strip.

    Rows are sorted so that the members come before the askers: a task holds the
    members and takes the askers a batch at a time.
    """
    def run(batches):
        last, members, ready = None, [], None
        for batch in batches:
            at = [batch.column(c).to_numpy(zero_copy_only=False) for c in (group, "block", "strip", "asks")]
            cut = np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0)) + 1
            g, b, strip, asks = at
            found = []
            bounds = [0, *cut, len(g)] if len(g) else []
            for s, e in zip(bounds, bounds[1:]):
                if (g[s], b[s], strip[s]) != last:
                    last, members, ready = (g[s], b[s], strip[s]), [], None
                part = batch.slice(s, e - s)
                if not asks[s]:
                    members.append(part)
                elif members:
                    if ready is None:
                        ready = meet.members(pa.Table.from_batches(members).combine_chunks())
                    found += meet.pairs(ready, part)
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=PAIR)

    rows = rows.repartition(group, "block", "strip").sortWithinPartitions(group, "block", "strip", "asks")
    return rows.mapInArrow(run, "a long, b long").distinct()


class Joined:
    """Which labels of a block are connected by the pairs given out so far."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while x in self.up:
            x = self.up[x]
        return x

    def spanning(self, label: int, labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Of the ``rows`` that meet a row of ``label``, one for each of their ``labels`` that was not connected with it.

        So the pairs of a block are fewer than its labels, and connect what all pairs would.
        """
        out = []
        for other, at in zip(*np.unique(labels, return_index=True)):
            a, b = self.root(int(label)), self.root(int(other))
            if a != b:
                self.up[max(a, b)] = min(a, b)
                out.append(rows[at])
        return np.array(out, np.int64)


class BySignature:
    """Close pairs of different clusters, as many as connect them."""

    def __init__(self, percent: int):
        self.percent = percent

    def members(self, rows) -> dict:
        out = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "cluster", "n", "out")}
        return out | {"joined": Joined(), "signature": np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(-1, VALUES)}

    def pairs(self, m: dict, askers) -> list[tuple[np.ndarray, np.ndarray]]:
        x, found = self.members(askers), []  # an asker has the columns of a member
        for k in range(len(x["cid"])):
            use = (m["cluster"] != x["cluster"][k]) & (~m["out"] | (m["cid"] > x["cid"][k]))
            r = np.flatnonzero(use)
            r = r[close(x["signature"][k], m["signature"][r], x["n"][k], m["n"][r], self.percent)]
            r = m["joined"].spanning(x["cluster"][k], m["cluster"][r], r)
            if len(r):
                found.append((np.full(len(r), x["cid"][k]), m["cid"][r]))
        return found


class BySet:
    """Linked pairs of different components, as many as connect them."""

    def __init__(self, width: int, percent: int):
        self.width, self.percent = width, percent

    def sets(self, rows) -> list[np.ndarray]:
        shingles = Shingles(self.width)
        batches = rows.to_batches() if isinstance(rows, pa.Table) else [rows]
        return [s for _, data, offsets in words.pieces(batches) for s in shingles.sets(data, offsets)]

    def members(self, rows) -> dict:
        out = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "component", "out")}
        sets = self.sets(rows)
        ids, place = np.unique(np.concatenate(sets), return_inverse=True)
        sizes = np.array([len(s) for s in sets])
        return out | {"joined": Joined(), "ids": ids, "place": place, "sizes": sizes, "starts": np.cumsum(sizes) - sizes}

    def pairs(self, m: dict, askers) -> list[tuple[np.ndarray, np.ndarray]]:
        found, mark = [], np.zeros(len(m["ids"]), np.int32)
        for cid, component, s in zip(askers.column("cid").to_pylist(), askers.column("component").to_pylist(), self.sets(askers)):
            at = np.searchsorted(m["ids"], s)
            at = at[m["ids"][np.minimum(at, len(mark) - 1)] == s]
            mark[at] = 1
            both = np.add.reduceat(mark[m["place"]], m["starts"])
            mark[at] = 0
            use = (100 * both >= self.percent * (m["sizes"] + len(s) - both)) & (m["component"] != component) & (~m["out"] | (m["cid"] > cid))
            r = np.flatnonzero(use)
            r = m["joined"].spanning(component, m["component"][r], r)
            if len(r):
                found.append((np.full(len(r), cid), m["cid"][r]))
        return found


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the distinct
    shingles of ``width`` words, or the whole sequence if there are fewer. Sets with 100 *
    intersection >= ``percent`` * union are linked, and component_id is the smallest
    doc_id reachable by links. First, documents with equal sets become one class.
    Classes that share a chunk key are candidates. Each meets the first class of its
    buckets; what is within the signature distance makes clusters. Clusters with close pairs
    that share a key become one, by as many pairs as connect them. All those pairs
    are confirmed on full sets, which makes
    components. Last, every pair inside a cluster that is not connected yet is decided: the
    classes outside the cluster's largest component are compared by full sets with all
    others, block by block. A large group of copies never makes all its pairs.

    Null or empty texts and texts without words have an empty set and link with nothing,
    as do rows with a null doc_id (component_id null, kept). Repeated rows get equal
    results. Columns other than doc_id and text are ignored; empty tables give no rows.
    """
    signed = saved(signatures(docs, width), "signatures")
    usable = signed.where("doc_id is not null and n > 0")
    classes = usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"), F.min("signature").alias("signature"))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    keys = chunk_keys(classes)
    hubs = keys.groupBy("key").agg(F.min("cid").alias("a"), F.count("*").alias("size")).where("size > 1").select("key", "a")
    pairs = keys.join(saved(hubs, "buckets"), "key").where("a <> cid").select("a", F.col("cid").alias("b")).distinct()
    stars = saved(signature_filter(saved(pairs, "stars"), classes, percent), "close-stars")

    def labelled(found: DataFrame, name: str, to: DataFrame) -> DataFrame:
        found = found.select(F.col("node").alias("cid"), F.col("component").alias(name))
        return to.join(found, "cid", "left").withColumn(name, F.coalesce(name, "cid"))

    known = saved(labelled(components(stars), "cluster", classes), "clusters")
    mixed = homes(chunk_keys(known, "cluster"), "key", "cluster")
    between = dealt(chunk_keys(known, "cluster"), mixed, "key", "cluster").join(known.select("cid", "n", "signature"), "cid")
    pairs = saved(stars.unionByName(meetings(between, "key", BySignature(percent))), "pairs")

    texts = class_texts(pairs, classes, docs, width)
    links = confirmed(pairs, texts, width, percent)
    merged = saved(labelled(components(pairs), "cluster", classes.select("cid")), "merged")
    inside = labelled(components(links), "component", merged)
    inside = saved(inside.select("cid", "cluster", "component"), "inside")
    inside = dealt(inside, homes(inside, "cluster", "component"), "cluster", "component").join(texts.hint("merge"), "cid")
    links = links.unionByName(saved(meetings(inside, "cluster", BySet(width, percent)), "inner-links"))

    joined = lambda found: labelled(found, "component", classes)
    named = saved(joined(components(links)).select("f1", "f2", "first", "component"), "components")
    least = saved(named.groupBy("component").agg(F.min("first").alias("component_id")), "named")
    named = saved(named.join(least, "component").select("f1", "f2", "component_id"), "class-components")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return (signed.select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one document of each group of near-duplicates: the one of the smallest doc_id.

    Of rows with equal doc_id and text one stays. A doc_id with several texts stays if any
    of them does. Rows with a null doc_id stay, as do null and empty texts. Columns may have any names; empty
    tables give no rows.

    The ids to act on grow with the input, so they meet the rows in one sort-merge join at every size;
    only ids that several rows share need those rows a second time.
    """
    found = saved(near_duplicates(docs, width, percent).where("doc_id is not null")
                  .groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
                  .where("not kept or rows > 1"), "acted-on")

    def without(ids: DataFrame) -> DataFrame:
        return docs.alias("d").join(ids.hint("merge").alias("f"), F.col("d.doc_id") == F.col("f.doc_id"), "left_anti").select("d.*")

    again = found.where("kept")
    if again.isEmpty():
        return without(found)
    several = docs.alias("d").join(again.hint("merge").alias("f"), F.col("d.doc_id") == F.col("f.doc_id"), "left_semi").select("d.*")
    return without(found).unionByName(several.dropDuplicates(["doc_id", "text"]))
