"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Spark computes the statistics of every document in one pass over the texts and stores
them. Trees are fitted in numpy on a bounded, hashed draw of the labelled documents' statistics,
flattened into arrays, and walked by all rows of a batch and all trees at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import saved
from .langid import held_out

#: Labelled documents of each label that the trees are fitted on, about, at most.
LABELLED = 20_000
#: Trees, their depth, bins of a feature, step size, weight of a leaf towards 0, least sum of second derivatives of a leaf.
TREES, DEPTH, BINS, RATE, SHRINK, LEAST = 60, 4, 64, 0.2, 1.0, 2.0
#: Fixed value: documents with this score or more are of good quality.
GOOD = 0.7

FEATURES = ["log_bytes", "log_words", "log_lines", "upper", "lower", "digits", "stops", "commas", "signs", "spaces", "non_ascii", "control",
            "entropy", "commonest_sign", "word_length", "word_length_spread", "longest_word", "capitalised", "all_upper", "sign_words",
            "sign_ends", "stop_ends", "distinct_words", "commonest_word", "repeats_last", "words_per_line", "distinct_lines", "short_lines"]

CODE = np.arange(256)
UPPER, LOWER, DIGIT = [(CODE >= ord(a)) & (CODE <= ord(b)) for a, b in ("AZ", "az", "09")]
SPACE, CONTROL = ~words.WORD, (CODE < 32) & words.WORD
STOP, COMMA = np.isin(CODE, list(b".!?")), np.isin(CODE, list(b",;:'\"-()"))
SIGN = (CODE > 32) & (CODE < 127) & ~(UPPER | LOWER | DIGIT | STOP | COMMA)
#: One row for each of the byte classes upper ... control.
CLASSES = np.stack([UPPER, LOWER, DIGIT, STOP, COMMA, SIGN, SPACE, CODE >= 128, CONTROL]).astype(float)


def byte_counts(text: np.ndarray) -> np.ndarray:
    """How often each byte occurs, block by block, so that a very long text needs little memory."""
    out = np.zeros(256, np.int64)
    for i in range(0, len(text), words.PIECE):
        out += np.bincount(text[i:i + words.PIECE], minlength=256)
    return out


def line_numbers(text: np.ndarray) -> tuple[float, float, float]:
    """Lines with text, the share of them that are different, and the share shorter than 20 bytes."""
    lines = [x for x in text.tobytes().split(b"\n") if x.strip()]
    n = len(lines)
    return n, len(set(lines)) / n if n else 1.0, sum(len(x) < 20 for x in lines) / n if n else 0.0


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ``FEATURES`` of every text of a piece, one row each; a text without words has zeros and a few ones."""
    w = words.Words(data, offsets)
    hashes, length = words.Words(data, offsets, lower=True).hashes(), (w.ends - w.begins).astype(float)
    first, last = data[w.begins], data[w.ends - 1]
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for i in range(len(out)):
        text, own = data[offsets[i]:offsets[i + 1]], w.text(i)
        n, size = own.stop - own.start, max(len(text), 1)
        counts = byte_counts(text)
        share = counts[counts > 0] / size
        lines, different, short = line_numbers(text)
        row = [np.log1p(len(text)), np.log1p(n), np.log1p(lines), *(CLASSES @ counts / size), -(share * np.log2(share)).sum(),
               (counts * SIGN).max() / size]
        if n:
            h, f, e, k = hashes[own], first[own], last[own], length[own]
            _, often = np.unique(h, return_counts=True)
            spans = np.stack([w.begins[own], w.ends[own]], 1).reshape(-1) - offsets[i]
            inside = lambda mask: np.add.reduceat(np.append(mask[text], False), spans, dtype=np.int32)[::2]
            upper, lower, letters = inside(UPPER), inside(LOWER), inside(UPPER | LOWER | DIGIT | (CODE >= 128))
            row += [k.mean(), k.std(), np.log1p(k.max()), UPPER[f].mean(), ((upper > 1) & (lower == 0)).mean(), (letters == 0).mean(),
                    SIGN[e].mean(), STOP[e].mean(), len(often) / n, often.max() / n, (h[1:] == h[:-1]).sum() / n, n / lines, different, short]
        out[i, :len(row)] = row
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for every row of ``docs`` (doc_id, text): the ``FEATURES`` of the whole text; null is like empty."""

    def measure(batches):
        for batch, data, offsets in words.pieces(batches):
            x = statistics_of(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
            yield pa.record_batch([batch.column("doc_id"), lists], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(measure, "doc_id long, x array<double>")


class Trees:
    """Fitted trees as arrays over all their nodes: a row goes left where x[feature] <= threshold; a leaf leads to itself."""

    def __init__(self, start: float):
        self.start, self.roots = start, []
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def node(self) -> int:
        at = len(self.value)
        for column, x in ((self.feature, 0), (self.threshold, np.inf), (self.left, at), (self.right, at), (self.value, 0.0)):
            column.append(x)
        return at

    def flat(self) -> Trees:
        for name in ("roots", "feature", "threshold", "left", "right", "value"):
            setattr(self, name, np.asarray(getattr(self, name), float if name in ("threshold", "value") else np.int32))
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for every row of ``x``."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Up to BINS - 1 cut points of each feature, between neighbouring quantiles of the sample."""
    out = []
    for column in x.T:
        q = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="nearest"))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def best_splits(bins: np.ndarray, node: np.ndarray, n: int, g: np.ndarray, h: np.ndarray):
    """For each of ``n`` open nodes the gain, feature and bin of the best cut, from histograms of ``g`` and ``h``.

    ``node`` is the number of each row's node, -1 for rows in finished leaves; of equal gains the first feature and
    bin are taken.
    """
    own = node >= 0
    hist = np.empty((2, bins.shape[1], n, BINS))
    for f in range(bins.shape[1]):
        cell = node[own] * BINS + bins[own, f]
        for k, v in enumerate((g, h)):
            hist[k, f] = np.bincount(cell, v[own], n * BINS).reshape(n, BINS)
    gl, hl = np.cumsum(hist, axis=3)
    gt, ht = gl[:, :, -1:], hl[:, :, -1:]
    gain = gl ** 2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt ** 2 / (ht + SHRINK)
    gain = np.where((hl >= LEAST) & (ht - hl >= LEAST), gain, 0.0).transpose(1, 0, 2).reshape(n, -1)
    best = gain.argmax(axis=1)
    return gain[np.arange(n), best], best // BINS, best % BINS


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Trees for the labels ``y`` (0 or 1), each row counted ``weight`` times, by Newton boosting of the log loss."""
    prior = np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    trees, edges = Trees(float(np.log(prior / (1 - prior)))), bin_edges(x)
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    margin = np.full(len(y), trees.start)
    for _ in range(TREES if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        leaf = np.full(len(y), trees.node())
        trees.roots.append(leaf[0])
        level = [leaf[0]]
        for _ in range(DEPTH):
            number = np.full(len(trees.value), -1)
            number[level] = np.arange(len(level))
            gains, features, cuts = best_splits(bins, number[leaf], len(level), g, h)
            grown = []
            for at, gain, f, cut in zip(level, gains, features, cuts):
                if gain > 1e-9 and cut < len(edges[f]):
                    rows = np.flatnonzero(leaf == at)
                    trees.feature[at], trees.threshold[at] = int(f), float(edges[f][cut])
                    trees.left[at], trees.right[at] = trees.node(), trees.node()
                    leaf[rows] = np.where(bins[rows, f] <= cut, trees.left[at], trees.right[at])
                    grown += [trees.left[at], trees.right[at]]
            if not grown:
                break
            level = grown
        sums = [np.bincount(leaf, v, len(trees.value)) for v in (g, h)]
        step = -RATE * sums[0] / (sums[1] + SHRINK)
        for at in np.unique(leaf):
            trees.value[at] = float(step[at])
        margin += step[leaf]
    return trees.flat()


def drawn_labels(measured: DataFrame, labels: DataFrame, label: str) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, y`` of about ``LABELLED`` measured documents of each label at most, by a hash of their id, and the counts before the draw.

    Held-out ids, null ids and null labels are left out; an id with both labels has the higher one.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), label)
    y = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    present = saved(y.join(measured.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi"), "quality-labels")
    counts = {r["y"]: r["n"] for r in present.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return present, counts
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, LABELLED / n))])[F.col("y")]
    return present.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)), counts


def fitted_on(measured: DataFrame, labels: DataFrame, label: str = "quality") -> Trees:
    """Trees for ``label`` of ``labels``, fitted on the statistics ``measured`` (doc_id, x); without labels every score is 0.5.

    The drawn ids are few enough to be broadcast (``LABELLED`` of each label), and the rows that reach the driver are as many. Rows are weighed so that each label has its share
    before the draw. Of rows with one id, one is learned from.
    """
    drawn, counts = drawn_labels(measured, labels, label)
    if not counts:
        return Trees(0.0).flat()
    got = (measured.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("x").alias("x"))
           .orderBy("doc_id").collect())
    if not got:
        return Trees(0.0).flat()
    y = np.array([r["y"] for r in got])
    weight = np.array([counts.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)])[y]
    return fitted(np.array([r["x"] for r in got]), y, weight * len(y) / weight.sum())


def score(measured: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id, score`` for every row of ``measured``."""

    def walk(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.record_batch([batch.column("doc_id"), pa.array(trees.scores(x))], names=["doc_id", "score"])

    return measured.select("doc_id", "x").mapInArrow(walk, "doc_id long, score double")


def score_quality(docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted; learned from ``labels`` (doc_id, quality).

    score is the probability, by the trees, that quality is 1; predicted is 1 from ``good`` on.
    Documents whose crc32(doc_id as text) mod 4 is 2 are held out: their labels are not used.
    Scores depend on the whole text alone, so repeated rows and equal texts get equal ones. A
    null text is scored like an empty one. A null doc_id is neither held out nor learned from. Null labels and
    labels without a document are ignored. With no label at all every score is 0.5; with labels
    of one kind it is 0.001 or 0.999. Other columns are ignored; an empty table gives no rows.
    """
    measured = saved(statistics(docs), "quality-statistics")
    found = score(measured, fitted_on(measured, labels))
    predicted: Column = (F.col("score") >= good).cast("int")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
