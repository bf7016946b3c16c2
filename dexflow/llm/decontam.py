"""Benchmark decontamination: CGK embeddings of item-sized windows, bit-sampling LSH, exact edit distance."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .words import U

#: Benchmark items that one pass over the documents looks for; more items are more passes.
ITEMS = 5000
#: Edits per word of an item that still count as the item, and the share of such windows to find.
EDITS, RECALL = 0.2, 0.999
#: Positions of the embedding that a table samples, and tables of a walk.
SAMPLED, TABLES = 3, 8
#: Items of a class have lengths within this ratio.
RATIO = 1.2
#: Edited items that measure the recall of a class, the walks that each is searched with, and the most walks of a class:
#: one that would need more compares its items with every window that the q-gram bound leaves.
TRIALS, MEASURED, MOST = 60, 16, 64

#: A-Z lower-cased; ASCII characters that are no letters or digits are spaces.
PLAIN = words.LOWER.copy()
PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0x20

MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64())])
MATCHES = "doc_id long, item_id long, start_word long, n_words long, edits long"


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, and where each text's begin."""
    w = words.Words(PLAIN[data], offsets)
    return w.hashes(), w.first


def allowed(n: int) -> int:
    return int(EDITS * n + 1e-9)


def pairs_of(hashes: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words."""
    return words.mix(hashes[:-1] * U(0x9E3779B97F4A7C15) + hashes[1:])


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest edits that make ``item`` a run of ``text``, and where that run ends (the first such)."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min()), int(row.argmin())


class Walk:
    """CGK embedding: a walk reads a word at every step and, by a random bit of (step, word), goes on or stays.

    Two runs of words that differ by few edits soon walk in step again, so most positions of their
    embeddings agree.
    """

    def __init__(self, seed: int, steps: int):
        self.seed, self.steps = seed, steps

    def bits(self, hashes: np.ndarray) -> list[np.ndarray]:
        """64 random bits per word for every 64 steps."""
        return [words.mix(hashes ^ words.mix(np.array([self.seed * 1000 + k], U))) for k in range(-(-self.steps // 64))]

    def visit(self, hashes: np.ndarray, bits: list[np.ndarray], starts: np.ndarray):
        """At each step, the words (hashes) that the walks from ``starts`` read; the end of the words reads as 0."""
        at, end = starts.copy(), len(hashes) - 1
        for step in range(self.steps):
            yield step, hashes[at]
            at = at + ((bits[step // 64][at] >> U(step % 64)) & U(1)).astype(np.int64)
            np.minimum(at, end, out=at)


class Class:
    """Items of similar length, with the sampled positions and the keys of their embeddings, per walk and table."""

    def __init__(self, items: list[tuple[int, np.ndarray]], seed: int):
        self.items = items
        self.low, self.high = min(len(x) for _, x in items), max(len(x) for _, x in items)
        self.rng_seed = seed
        #: Walks that reach RECALL; None: all windows within the q-gram bound are candidates.
        self.walks: int | None = MEASURED
        #: Pairs of neighbouring words that a window of ``low`` words has from the item: each edit costs two.
        self.needed = self.low - 1 - 2 * allowed(self.high)

    def samples(self, walk: int) -> list[np.ndarray]:
        """Sampled steps of each table, out of those in which a walk reads the first ``low`` words (two steps a word)."""
        rng = np.random.default_rng([self.rng_seed, walk])
        steps = max(1, 2 * self.low - 2)
        return [np.sort(rng.choice(steps, min(SAMPLED, steps), replace=False)) for _ in range(TABLES)]


def table_keys(walk: Walk, number: int, classes: list[Class], hashes: np.ndarray, starts: np.ndarray, of_class: list[np.ndarray]) -> list[np.ndarray]:
    """Keys (table, start) per class, for the starts ``starts[of_class[c]]``."""
    keys = [np.zeros((TABLES, len(rows)), U) for rows in of_class]
    uses: dict[int, list[tuple[int, int]]] = {}
    for c, rows in enumerate(of_class):
        for t, steps in enumerate(classes[c].samples(number) if len(rows) else []):
            for step in steps:
                uses.setdefault(int(step), []).append((c, t))
    for step, seen in walk.visit(hashes, walk.bits(hashes), starts):
        for c, t in uses.pop(step, []):
            keys[c][t] = words.mix(keys[c][t] * U(31) + seen[of_class[c]] + U(t))
        if not uses:
            break
    return keys


def edited(x: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``x`` after random edits: words put in, replaced or taken out."""
    y = list(x)
    for _ in range(edits):
        at, kind, word = int(rng.integers(len(y) + 1)), int(rng.integers(3)), int(rng.integers(1 << 62))
        if kind == 0:
            y.insert(at, word)
        elif y[at:at + 1]:
            y[at:at + 1] = [word] if kind == 1 else []
    return np.array(y, U)


def walks_for(c: Class) -> int | None:
    """Walks that find windows with the most edits allowed with probability RECALL; None if that takes more than MOST.

    Measured for the class: of TRIALS items with that many random edits each gives the rate q at which a walk
    finds it, and the walks w are the fewest with a mean of (1 - q)^w of at most 1 - RECALL, so that items
    that are hard to find count as such.
    """
    rng = np.random.default_rng([5, c.rng_seed])
    chosen = [i for i in c.items if allowed(len(i[1]))]
    if not chosen:
        return 1
    chosen = [chosen[k] for k in rng.choice(len(chosen), TRIALS, replace=len(chosen) < TRIALS)]
    texts = [np.concatenate([rng.integers(1 << 62, size=9).astype(U), edited(x, allowed(len(x)), rng), np.zeros(1, U)]) for _, x in chosen]
    first = np.cumsum([0] + [len(t) for t in texts])
    found, wanted = Searcher(c.items, walks=MEASURED), {(t, i) for t, (i, _) in enumerate(chosen)}
    hits = np.zeros(TRIALS)
    for w in range(MEASURED):
        for t in {t for t, i, _ in found.candidates(np.concatenate(texts), first, only=w) if (t, i) in wanted}:
            hits[t] += 1
    missed = 1 - (hits + 0.5) / (MEASURED + 1)
    return next((w for w in range(1, MOST + 1) if (missed ** w).mean() <= 1 - RECALL), None)


class Searcher:
    """One block of benchmark items, ready to search texts."""

    def __init__(self, items: list[tuple[int, np.ndarray]], walks: int | None = None):
        items = sorted((i for i in items if len(i[1])), key=lambda i: (len(i[1]), i[0]))
        groups: list[list] = []
        for item in items:
            if not groups or len(item[1]) > RATIO * len(groups[-1][0][1]):
                groups.append([])
            groups[-1].append(item)
        self.classes = [Class(g, k) for k, g in enumerate(groups)]
        self.known = np.unique(np.concatenate([pairs_of(x) for _, x in items])) if items else np.empty(0, U)
        self.steps = max((2 * c.high for c in self.classes), default=0)
        for c in self.classes:
            c.walks = walks if walks is not None else walks_for(c)
        self.walks = max((c.walks or 0 for c in self.classes), default=0)
        self.tables = []
        for w in range(self.walks):
            per = []
            for c in self.classes:
                if w >= (c.walks or 0):
                    per.append(None)
                    continue
                joined = np.concatenate([np.append(x, U(0)) for _, x in c.items])
                starts = np.cumsum([0] + [len(x) + 1 for _, x in c.items])[:-1]
                keys = table_keys(Walk(w, self.steps), w, [c], joined, starts, [np.arange(len(starts))])[0]
                order = keys.argsort(axis=1)
                per.append((np.take_along_axis(keys, order, 1), order))
            self.tables.append(per)

    def candidates(self, hashes: np.ndarray, first: np.ndarray, only: int | None = None) -> set[tuple[int, int, int]]:
        """(text, item, start) of the windows whose keys in some table are an item's.

        Only windows with as many neighbouring words of the benchmark as an item within the edits
        must have are walked (the q-gram lemma); it drops no window that could match.
        """
        if not len(hashes) or not self.classes:
            return set()
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        end, place = first[1:][text], np.arange(len(hashes))
        known = np.zeros(len(hashes) + 1, np.int64)
        if len(self.known) and len(hashes) > 1:
            pairs = pairs_of(hashes)
            at = np.minimum(np.searchsorted(self.known, pairs), len(self.known) - 1)
            known[2:] = np.cumsum((self.known[at] == pairs) & (text[1:] == text[:-1]))
        # known[j] counts the pairs that end before word j; the pairs inside [s, e) end after word s
        dense = [np.flatnonzero(known[np.minimum(place + c.low, end)] - known[np.minimum(place + 1, end)] >= c.needed)
                 for c in self.classes]
        starts = np.unique(np.concatenate(dense))
        if not len(starts):
            return set()
        of_class = [np.searchsorted(starts, d) for d in dense]
        padded = np.append(hashes, U(0))
        out = {(int(text[s]), item, int(s)) for c, d in zip(self.classes, dense) if c.walks is None for s in d for item, _ in c.items}
        for w in [only] if only is not None else range(self.walks):
            walked = [rows if w < (c.walks or 0) else rows[:0] for c, rows in zip(self.classes, of_class)]
            for c, keys in enumerate(table_keys(Walk(w, self.steps), w, self.classes, padded, starts, walked)):
                if not len(walked[c]):
                    continue
                known_keys, order = self.tables[w][c]
                items = self.classes[c].items
                for t in range(TABLES):
                    lo = np.searchsorted(known_keys[t], keys[t], "left")
                    hi = np.searchsorted(known_keys[t], keys[t], "right")
                    for k in np.flatnonzero(hi > lo):
                        s = int(starts[of_class[c][k]])
                        out.update((int(text[s]), items[order[t, r]][0], s) for r in range(lo[k], hi[k]))
        return out

    def matches(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start word, words, edits) of each text's best run for each item it holds."""
        by_id = {i: x for c in self.classes for i, x in c.items}
        pairs = {i: pairs_of(x) for i, x in by_id.items()}
        spots: dict[tuple[int, int], list[int]] = {}
        for text, item, start in self.candidates(hashes, first):
            spots.setdefault((text, item), []).append(start)
        out = []
        for (text, item), starts in sorted(spots.items()):
            x = by_id[item]
            k, best = allowed(len(x)), None
            checked = -1
            for s in sorted(starts):
                if s + k <= checked:  # runs that start within k words of s were inside the last region
                    continue
                low = max(int(first[text]), s - 2 * k - 1)
                high = min(int(first[text + 1]), s + len(x) + 3 * k + 1)
                checked = s + 2 * k
                own = np.isin(pairs_of(hashes[low:high]), pairs[item])
                if own.sum() < len(x) - 1 - 2 * k:
                    continue
                edits, stop = best_match(x, hashes[low:high])
                start = low + max(0, stop - len(x)) - int(first[text])
                if edits <= k and (best is None or edits < best[0]):
                    best = (edits, start)
                if edits == 0:
                    break
            if best:
                out.append((text, item, best[1], len(x), best[0]))
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, edits``: the benchmark items that documents hold, with few edits.

    Words are runs of ASCII letters, digits and other than ASCII characters, A-Z
    lower-cased. A document holds an item if at most ``EDITS`` edits (words inserted,
    deleted or replaced) per word of the item make it a run of the document's words. Windows at
    every word are candidates by tables of sampled embedding positions, as many as
    reach ``RECALL`` for items of their length (beyond ``MOST`` walks, all windows within the q-gram
    bound are candidates), and the exact edit distance decides. start_word is about where the run begins.

    The benchmark is a set of queries, taken in blocks of ``ITEMS``; each block is a pass over the documents,
    without a shuffle. Null or empty items and texts match nothing; a null doc_id is
    reported as null, and a null item_id does not take part. Items with the same id are all
    searched and reported by that id; rows with the same doc_id are searched apart. Other columns are
    ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    blocks = max(1, -(-items.count() // ITEMS))
    found = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        keys, texts = [], []
        for r in sorted(rows, key=lambda r: (r["item_id"], r["text"])):
            data = np.frombuffer(r["text"].encode(), np.uint8)
            texts.append(word_hashes(data, np.array([0, len(data)]))[0])
            keys.append(r["item_id"])
        searcher = Searcher(list(enumerate(texts)))

        def search(batches, searcher=searcher, keys=keys):
            for batch, data, offsets in words.pieces(batches):
                out: dict[tuple, tuple] = {}
                for text, item, *rest in searcher.matches(*word_hashes(data, offsets)):
                    at = (text, keys[item])
                    out[at] = min(out.get(at, tuple(rest)), tuple(rest), key=lambda x: (x[2], x[0]))
                if out:
                    ids = batch.column("doc_id").to_pylist()
                    rows = [(ids[t], i, *r) for (t, i), r in sorted(out.items())]
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), MATCH)], schema=MATCH)

        some = base.mapInArrow(search, MATCHES)
        found = some if found is None else found.unionByName(some)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds no benchmark item; rows with a null doc_id stay.

    Null and empty texts hold none and stay; of a doc_id with several texts all rows go if one holds an
    item; repeated rows go or stay together. Columns may have any names; an empty table gives no rows, an empty benchmark all.
    """
    from .common import saved

    bad = saved(contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.alias("d").join(bad.alias("f"), F.col("d.doc_id") == F.col("f.doc_id"), "left_anti").select("d.*")
