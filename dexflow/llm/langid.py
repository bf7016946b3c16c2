"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads the bytes of a segment (a word between spaces, or 64 bytes of a longer
one) from both sides and gives every position language probabilities; a document's are the mean over all its
positions. Its state begins anew with each segment, so equal segments have equal
probabilities, and a task runs the network once for each different one that it holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words

#: Units of each direction, bytes of a segment, segments remembered by a task.
HIDDEN, SEGMENT, MEMORY = 16, 64, 1_000_000
#: Training: documents drawn per language, segments of each, passes, segments of a step, step size.
DOCUMENTS, SEGMENTS, PASSES, STEP, RATE = 300, 64, 4, 512, 0.01
#: More different values than this are no language labels.
LANGUAGES = 1000
SPACE = 0x20


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Direction:
    """A gated recurrent layer: ``inputs`` has a row of 3H values per byte, ``state`` is H by 3H."""

    def __init__(self, inputs: np.ndarray, state: np.ndarray):
        self.inputs, self.state = inputs, state

    def run(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Outputs (position, segment, H) for the bytes ``x`` (segment, position), and what backward() needs."""
        n, length = x.shape
        size = self.state.shape[0]
        h = np.zeros((n, size), np.float32)
        out, kept = np.empty((length, n, size), np.float32), []
        for t in range(length):
            g, a = self.inputs[x[:, t]], h @ self.state
            gates = sigmoid(g[:, :2 * size] + a[:, :2 * size])
            z, r, c = gates[:, :size], gates[:, size:], a[:, 2 * size:]
            new = np.tanh(g[:, 2 * size:] + r * c)
            if keep:
                kept.append((h, z, r, c, new))
            h = new + z * (h - new)
            out[t] = h
        return out, kept

    def backward(self, x: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of inputs and state by backpropagation through time."""
        d_inputs, d_state = np.zeros_like(self.inputs), np.zeros_like(self.state)
        dh = np.zeros_like(dout[0])
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, c, new = kept[t]
            dh = dh + dout[t]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (h - new) * z * (1 - z)
            d_r = d_new * c * r * (1 - r)
            da = np.concatenate([d_z, d_r, d_new * r], axis=1)
            np.add.at(d_inputs, x[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
            d_state += h.T @ da
            dh = dh * z + da @ self.state.T
        return d_inputs, d_state


class Network:
    """Both directions and the output layer; ``languages`` names its columns."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.languages = languages
        self.weights = [draw(256, 3 * HIDDEN, scale=0.3), draw(HIDDEN, 3 * HIDDEN, scale=0.25),
                        draw(256, 3 * HIDDEN, scale=0.3), draw(HIDDEN, 3 * HIDDEN, scale=0.25),
                        draw(2 * HIDDEN, len(languages), scale=0.2), np.zeros(len(languages), np.float32)]

    def positions(self, x: np.ndarray, keep: bool = False):
        """Probabilities (position, segment, language) of each byte between the two spaces around a segment."""
        fi, fs, bi, bs, w, b = self.weights
        forward, fk = Direction(fi, fs).run(x, keep)
        backward, bk = Direction(bi, bs).run(x[:, ::-1], keep)
        h = np.concatenate([forward, backward[::-1]], axis=2)[1:-1]
        s = h @ w + b
        s = np.exp(s - s.max(axis=2, keepdims=True))
        return s / s.sum(axis=2, keepdims=True), (h, fk, bk)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over all positions of the segments ``x`` with languages ``y``."""
        fi, fs, bi, bs, w, _ = self.weights
        p, (h, fk, bk) = self.positions(x, keep=True)
        p[:, np.arange(len(y)), y] -= 1
        p /= p.shape[0] * p.shape[1]
        dh = np.zeros((x.shape[1], len(x), 2 * HIDDEN), np.float32)
        dh[1:-1] = p @ w.T
        df = Direction(fi, fs).backward(x, fk, dh[:, :, :HIDDEN])
        db = Direction(bi, bs).backward(x[:, ::-1], bk, dh[::-1, :, HIDDEN:])
        return [*df, *db, np.einsum("tnh,tnk->hk", h, p), p.sum(axis=(0, 1))]


def padded(segments: list[bytes]) -> np.ndarray:
    """Segments of one length as rows of bytes, with a space on each side."""
    x = np.full((len(segments), len(segments[0]) + 2), SPACE, np.uint8)
    x[:, 1:-1] = np.frombuffer(b"".join(segments), np.uint8).reshape(len(segments), -1)
    return x


def trained(examples: list[tuple[str, bytes]], seed: int = 7) -> Network | None:
    """A network fitted to (language, words) examples with Adam; None without examples."""
    languages = sorted({lang for lang, _ in examples})
    if not languages:
        return None
    net, rng = Network(languages, seed), np.random.default_rng(seed)
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for lang, text in examples:
        for word in text.split():
            for i in range(0, len(word), SEGMENT):
                part = word[i:i + SEGMENT]
                by_length.setdefault(len(part), []).append((part, languages.index(lang)))
    first, second, n = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    for _ in range(PASSES):
        steps = []
        for length in sorted(by_length):
            order = rng.permutation(len(by_length[length]))
            steps += [[by_length[length][k] for k in order[i:i + STEP]] for i in range(0, len(order), STEP)]
        for k in rng.permutation(len(steps)):
            grads = net.gradients(padded([s for s, _ in steps[k]]), np.array([y for _, y in steps[k]]))
            n += 1
            for w, g, a, b in zip(net.weights, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= RATE * (a / (1 - 0.9 ** n)) / (np.sqrt(b / (1 - 0.999 ** n)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def draw_examples(docs: DataFrame, documents: int = DOCUMENTS, segments: int = SEGMENTS) -> list[tuple[str, bytes]]:
    """(language, words) of about ``documents`` documents per language, ``segments`` words of each.

    Only documents that are not held out, with a doc_id, text and lang, are
    drawn, by a hash of their id, and of rows with one id one is; words are taken evenly over the whole text, of a
    longer one its first 4 segments (predictions read all of it). So the driver gets a bounded sample, whatever the size
    of the table. More than ``LANGUAGES`` values of lang are an error.
    """
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different values of lang")
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, v in counts.items() for x in (k, min(1.0, documents / v))])[F.col("lang")]
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))

    def some(batches):
        for batch in batches:
            out = []
            for doc, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                w = text.encode().split()
                at = np.unique(np.linspace(0, len(w) - 1, min(len(w), segments)).astype(int)) if w else []
                out.append((doc, lang, b" ".join(w[i][:4 * SEGMENT] for i in at)))
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=["doc_id", "lang", "words"])

    found = rows.select("doc_id", "lang", "text").mapInArrow(some, "doc_id long, lang string, words binary")
    found = found.groupBy("doc_id").agg(F.min(F.struct("lang", "words")).alias("r")).collect()
    return sorted((r["r"]["lang"], bytes(r["r"]["words"])) for r in found)


class Memory:
    """Summed position probabilities of the segments seen so far, by hash."""

    def __init__(self, net: Network):
        self.net, self.known, self.sums = net, np.empty(0, np.uint64), np.empty((0, len(net.languages)), np.float32)

    def of(self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The sums of the segments data[begins:ends], in their order."""
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        old = np.zeros(len(unique), bool)
        if len(self.known):
            old = self.known[np.minimum(at, len(self.known) - 1)] == unique
        sums = np.empty((len(unique), len(self.net.languages)), np.float32)
        sums[old] = self.sums[at[old]]
        new = np.flatnonzero(~old)
        sums[new] = self.fresh(begins[first[new]], ends[first[new]], data)
        if len(self.known) + len(new) > MEMORY:
            self.known, self.sums = unique, sums
        else:
            self.known, self.sums = np.insert(self.known, at[new], unique[new]), np.insert(self.sums, at[new], sums[new], axis=0)
        return sums[back]

    def fresh(self, begins: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        sums, lengths = np.empty((len(begins), len(self.net.languages)), np.float32), ends - begins
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            for i in range(0, len(rows), 4096):
                part = rows[i:i + 4096]
                x = np.full((len(part), length + 2), SPACE, np.uint8)
                x[:, 1:-1] = data[begins[part][:, None] + np.arange(length)]
                sums[part] = self.net.positions(x)[0].sum(axis=0)
        return sums


def cut_segments(w: words.Words) -> None:
    """Cut words longer than a segment."""
    lengths = w.ends - w.begins
    if len(lengths) and lengths.max() > SEGMENT:
        parts = -(-lengths // SEGMENT)
        begins = np.repeat(w.begins, parts) + SEGMENT * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        w.ends = np.minimum(begins + SEGMENT, np.repeat(w.ends, parts))
        w.begins = begins


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs``, all columns, with lang_pred and score for every row, from all of its ``text``.

    lang_pred is ``und`` with score 0 if the text is null or has no letter, or if nothing was learned;
    of languages with equal probability the first by name is taken. Columns named lang_pred or
    score are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    if net is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    def label(batches):
        memory = Memory(net)
        names = np.array(net.languages, object)
        for batch, data, offsets in words.pieces(batches):
            w = words.Words(data, offsets)
            cut_segments(w)
            text = np.searchsorted(offsets, w.begins, "right") - 1
            sums = memory.of(w.hashes(), w.begins, w.ends, data)
            total = np.bincount(text, (w.ends - w.begins).astype(float), batch.num_rows)
            pooled = np.stack([np.bincount(text, sums[:, k], batch.num_rows) for k in range(len(names))], 1) / np.maximum(total, 1)[:, None]
            best = pooled.argmax(axis=1)
            ok = batch.column("lang_pred").to_numpy(zero_copy_only=False).astype(bool) & (total > 0)
            score = np.where(ok, np.clip(pooled[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.record_batch([*batch.columns[:-1], pa.array(np.where(ok, names[best], "und"), pa.string()), pa.array(score)],
                                  names=[*batch.schema.names, "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "lang_pred string, score double"])
    return docs.withColumn("lang_pred", has_letter()).mapInArrow(label, schema)


def identify_languages(docs: DataFrame) -> DataFrame:
    """Train on ``docs`` (doc_id, text, lang) and predict every row: doc_id, held_out, lang_pred, score.

    Documents whose crc32(doc_id as text) mod 4 is 2 are held out: nothing is
    learned from them. Null or empty texts are ``und``; a null doc_id is neither held out nor
    learned from; a null lang is not learned from. Repeated rows get equal results.
    Other columns are ignored; an empty table gives no rows. A score is the mean
    probability of the language over all positions of the text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    found = predict(docs.select("doc_id", "text"), trained(draw_examples(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is identified with a score of at least ``least``; columns as they are.

    Rows whose text is null, empty or without a letter go. Where nothing can be learned (no row that
    is not held out has doc_id, text and lang) no language can be rejected, and every row with a letter
    stays. Repeated rows are judged alike; a null doc_id or lang is no reason to go; an empty table gives no rows.
    """
    net = trained(draw_examples(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")))
    if net is None:
        return docs.where(has_letter())
    judged = predict(docs.select("text", F.struct(*docs.columns).alias("row")), net)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("row.*")
