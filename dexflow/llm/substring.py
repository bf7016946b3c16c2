"""Substring dedup: difference-cover anchors find long word runs that documents share, windows decide."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import saved
from .words import U

#: A perfect difference cover: for any two places there is a shift below PERIOD that
#: brings both to cover places.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)

ANCHOR = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32())])
HASH = pa.schema([("anchor", pa.int64())])
WINDOW = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32())])
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def anchors(docs: DataFrame, width: int, places: bool) -> DataFrame:
    """Hashes of the ``width`` words from every cover place of every text, with doc_id and place if asked for."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def find(batches):
        by_word = words.Rolling(words.WORD_STEP)
        for batch, data, offsets in words.pieces(batches):
            w = words.Words(data, offsets)
            h = words.mix(words.window_hashes(w.hashes(), width, by_word)).view(np.int64)
            counts = np.diff(w.first)
            text = np.repeat(np.arange(len(counts)), counts)[:len(h)]
            place = np.arange(len(h)) - w.first[text]
            use = cover[place % PERIOD] & (place + width <= counts[text])
            if not places:
                yield pa.record_batch([pa.array(h[use])], schema=HASH)
                continue
            ids = batch.column("doc_id").take(pa.array(text[use]))
            yield pa.record_batch([pa.array(h[use]), ids, pa.array(place[use].astype(np.int32))], schema=ANCHOR)

    schema = "anchor long, doc_id long, place int" if places else "anchor long"
    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(find, schema)


def near_anchors(places: np.ndarray, n: int, reach: int = PERIOD) -> np.ndarray:
    """Which of ``n`` windows have an anchor at one of their first ``reach`` places."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, np.clip(places - reach + 1, 0, n), 1)
    np.add.at(d, np.clip(places + 1, 0, n), -1)
    return np.cumsum(d[:n]) > 0


EXTENDED = pa.schema([("doc_id", pa.int64()), ("covered", pa.list_(pa.int32())), ("asked", pa.list_(pa.int64()))])


def extend(doc: int, place: np.ndarray, anchor: np.ndarray, source: np.ndarray, source_place: np.ndarray,
           proves: np.ndarray, width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """What the anchors of a document prove, and what they leave open.

    Anchors (sorted by place) that overlap or touch and lie at the same distance in one
    smaller document extend each other: all words from the first to the end of the last are equal
    there. A run of ``length`` words or more is covered: start and end, one after the other.
    A window near an anchor that a smaller document has, and not inside a covered run, stays
    open; ``asked`` are the anchors of open windows.
    """
    earlier = source < doc
    place, anchor, source, source_place, proves = (x[earlier] for x in (place, anchor, source, source_place, proves))
    if not len(place):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    new = np.ones(len(place) + 1, bool)
    new[1:-1] = ((source[1:] != source[:-1]) | (np.diff(place) != np.diff(source_place)) | (np.diff(place) > width) | ~proves[1:])
    at = np.flatnonzero(new)
    start, end = place[at[:-1]], place[at[1:] - 1] + width
    long = (end - start >= length) & proves[at[:-1]]
    start, end = start[long], end[long]
    n = int(place[-1]) + 1
    open_ = near_anchors(place, n)
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, np.minimum(start, n), 1)
    np.add.at(inside, np.minimum(end - length + 1, n), -1)
    open_ &= np.cumsum(inside[:n]) == 0
    c = np.concatenate([[0], np.cumsum(open_)])
    asks = c[place + 1] - c[np.maximum(place - PERIOD + 1, 0)] > 0
    return np.stack([start, end], 1).reshape(-1).astype(np.int32), anchor[asks]


def extensions(shared: DataFrame, repeated: DataFrame, width: int, length: int) -> DataFrame:
    """``doc_id, covered, asked`` of every document with an anchor that a smaller one has.

    A doc_id that several rows have (``repeated``) may stand for different texts, whose places
    do not go together: its anchors prove nothing.
    """
    many = repeated.select(F.col("doc_id").alias("source"), F.lit(True).alias("many"))
    first = saved(shared.groupBy("anchor").agg(F.min(F.struct("doc_id", "place")).alias("s"))
                  .select("anchor", F.col("s.doc_id").alias("source"), F.col("s.place").alias("source_place"))
                  .join(many, "source", "left").withColumn("proves", F.col("many").isNull()).drop("many"), "sources")
    per = shared.join(first, "anchor").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "anchor", "source", "source_place", "proves"))).alias("found"))
    per = per.join(many.withColumnRenamed("source", "doc_id"), "doc_id", "left")

    def run(batches):
        for batch in batches:
            docs, found, many = batch.column("doc_id").to_pylist(), batch.column("found"), batch.column("many")
            out = []
            for i, doc in enumerate(docs):
                x = found[i].values
                fields = [x.field(k).to_numpy(zero_copy_only=False) for k in ("place", "anchor", "source", "source_place", "proves")]
                if many[i].is_valid:
                    fields[-1] = np.zeros(len(x), bool)
                c, q = extend(doc, *fields, width, length)
                if len(c) or len(q):
                    out.append((doc, c, q))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), EXTENDED)], schema=EXTENDED)

    return per.mapInArrow(run, "doc_id long, covered array<int>, asked array<long>")


def windows(texts: DataFrame, length: int) -> DataFrame:
    """``w1, w2, row, doc_id, place``: hash (128 bits) of every window that has an asked anchor."""

    def find(batches):
        by_word, other = words.Rolling(words.WORD_STEP), words.Rolling(words.OTHER_STEP)
        for batch, data, offsets in words.pieces(batches):
            w = words.Words(data, offsets)
            h = w.hashes()
            first = words.mix(words.window_hashes(h, length, by_word)).view(np.int64)
            second = words.mix(words.window_hashes(words.mix(h ^ U(0x5851F42D4C957F2D)), length, other)).view(np.int64)
            places = batch.column("places")
            chosen, texts_ = [], []
            for i in range(batch.num_rows):
                n = w.first[i + 1] - w.first[i] - length + 1
                if n > 0 and places[i].is_valid:
                    at = np.flatnonzero(near_anchors(places[i].values.to_numpy(), n))
                    chosen.append(at)
                    texts_.append(np.full(len(at), i))
            if chosen:
                at, text = np.concatenate(chosen), np.concatenate(texts_)
                here = w.first[text] + at
                yield pa.record_batch([pa.array(first[here]), pa.array(second[here]), batch.column("row").take(pa.array(text)),
                                       batch.column("doc_id").take(pa.array(text)), pa.array(at.astype(np.int32))], schema=WINDOW)

    return texts.where("places is not null").select("row", "doc_id", "text", "places").mapInArrow(
        find, "w1 long, w2 long, row long, doc_id long, place int")


def kept_words(texts: DataFrame, length: int) -> DataFrame:
    """Texts without the words of the ``covered`` runs and of the windows starting at ``starts``."""

    def cut(batches):
        for batch, data, offsets in words.pieces(batches):
            w = words.Words(data, offsets)
            starts, covered, out = batch.column("starts"), batch.column("covered"), []
            raw = data.tobytes()
            for i in range(batch.num_rows):
                n = int(w.first[i + 1] - w.first[i])
                parts = raw[offsets[i]:offsets[i + 1]].split()
                d = np.zeros(n + 1, np.int32)
                if starts[i].is_valid:
                    at = starts[i].values.to_numpy()
                    np.add.at(d, at, 1)
                    np.add.at(d, at + length, -1)
                if covered[i].is_valid:
                    runs = covered[i].values.to_numpy()
                    np.add.at(d, runs[::2], 1)
                    np.add.at(d, runs[1::2], -1)
                kept = np.cumsum(d[:n]) == 0
                if not kept.all():
                    parts = [parts[k] for k in np.flatnonzero(kept)]
                out.append((n, n - len(parts), hashlib.sha256(b" ".join(parts)).hexdigest()))
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(zip(*out), list(RESULT_ARROW)[1:])]],
                                  schema=RESULT_ARROW)

    return texts.select("doc_id", "text", "covered", "starts").mapInArrow(cut, RESULT)


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, with repeated word runs removed.

    A window is ``length`` consecutive words of one text. Every word goes that is covered by a
    window whose words also start in a document with a smaller doc_id, judged on
    the input. Two equal windows have, at one shift below ``PERIOD``, cover places in
    both texts, and the anchor of ``length - PERIOD + 1`` words from there lies inside
    the window. Anchors that occur once are dropped. The others extend to runs shared with
    the smallest document that has them (see ``extend``), which settles
    most words; windows that this leaves open, and those of other documents
    around the same anchors, are hashed in full (128 bits), and the smallest doc_id of
    each decides.

    A null text has no words; a null doc_id is left as it is and repeats nothing. Rows with the
    same doc_id are one document that does not repeat itself, each with its own
    result. Empty tables give no rows; columns other than doc_id and text are ignored. Texts may
    be of any length that fits a row.
    """
    if length < PERIOD:
        raise ValueError(f"windows have at least {PERIOD} words")
    width = length - PERIOD + 1
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    twice = saved(anchors(docs, width, False).groupBy("anchor").agg(F.count("*").alias("n"))
                  .where("n > 1").select("anchor"), "anchors")
    shared = saved(anchors(docs, width, True).join(twice, "anchor"), "shared")
    repeated = saved(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    runs = saved(extensions(shared, repeated, width, length), "runs")
    asked = saved(runs.select(F.explode("asked").alias("anchor")).distinct(), "asked")
    places = shared.join(asked, "anchor").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    known = saved(runs.select("doc_id", "covered").join(places, "doc_id", "outer"), "known")
    texts = saved(docs.join(known, "doc_id", "left").withColumn("row", F.monotonically_increasing_id()), "texts")
    found = windows(texts, length)
    least = found.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = saved(least.where("least < most").select("w1", "w2", "least"), "repeated")
    starts = (found.join(least, ["w1", "w2"]).where("least < doc_id").groupBy("row")
              .agg(F.collect_list("place").alias("starts")))
    starts = saved(starts, "starts")
    hit = texts.where("places is not null").select("row", "doc_id", "text", "covered").join(starts, "row", "left")
    miss = texts.where("places is null").select("doc_id", "text", "covered", F.lit(None).cast("array<int>").alias("starts"))
    return kept_words(hit.select("doc_id", "text", "covered", "starts").unionByName(miss), length)
