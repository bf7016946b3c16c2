"""Mixing to target weights: domain posteriors from a labelled table, document rates by least squares over rates of 0 or more."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import saved
from .words import U

#: Word features (hashed), and dense ones: shares of capitals, digits and signs, repetition, word length, size.
HASHED, DENSE = 1 << 18, 6
#: Labelled documents of a domain that the classifier is fitted on, about, at most; steps, step size and decay of the fit.
LABELLED, STEPS, RATE, DECAY = 6000, 150, 0.05, 1e-4
#: Documents whose words a step of the fit sums at once.
PART = 2000
#: Share of all tokens by which a domain may miss its target; where targets cannot be met, the share that the gradient may have.
CLOSE, FLAT = 1e-5, 1e-7
#: Weight of the squared distance of the rates from 1 against that of the totals from the targets.
RIDGE = 1e-6
#: Newton and gradient steps tried in a round, as multiples of the full step; rounds after which the fit is given up with an error.
NEWTON, GRADIENT, ROUNDS = (1.0, 0.5, 0.25, 0.0625, 0.0078125), (1.0, 8.0), 200

CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
SIGN = np.array([32 < c < 127 and not chr(c).isalnum() for c in range(256)])


class Features:
    """Features of the texts of a piece: distinct hashed words (index, document) and dense columns."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        w = words.Words(data, offsets, lower=True)
        text = np.repeat(np.arange(n, dtype=U), np.diff(w.first))
        both = np.unique((text << U(18)) | (w.hashes() & U(HASHED - 1)))
        self.text, self.index = (both >> U(18)).astype(np.int64), (both & U(HASHED - 1)).astype(np.int64)
        self.words = np.diff(w.first)
        size = np.maximum(np.diff(offsets), 1)
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
        distinct = np.bincount(self.text, minlength=n)
        self.dense = np.stack([total(CAPITAL[data]) / size, total(DIGIT[data]) / size, total(SIGN[data]) / size,
                               distinct / np.maximum(self.words, 1), np.minimum(size / np.maximum(self.words, 1) / 20, 5),
                               np.log1p(self.words) / 10], 1)
        self.weight = 1 / np.sqrt(np.maximum(distinct, 1))


class Classifier:
    """Multinomial logistic regression on hashed words and dense features."""

    def __init__(self, domains: list[str]):
        self.domains = domains
        self.hashed = np.zeros((HASHED, len(domains)), np.float32)
        self.dense = np.zeros((DENSE + 1, len(domains)))

    def posteriors(self, f: Features) -> np.ndarray:
        n = len(f.words)
        picked = self.hashed[f.index]
        s = np.stack([np.bincount(f.text, picked[:, k], n) for k in range(len(self.domains))], 1) * f.weight[:, None]
        s += f.dense @ self.dense[:-1] + self.dense[-1]
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)

    def fit(self, f: Features, y: np.ndarray) -> None:
        """Full-batch Adam on the mean cross entropy, summed part by part; only words of the sample get weights."""
        seen = np.zeros(HASHED, bool)
        seen[f.index] = True
        used, index = np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[f.index]
        n, k = len(y), len(self.domains)
        cuts = [*range(0, n, PART), n]
        ends = np.searchsorted(f.text, cuts)
        parts = [(slice(a, b), slice(lo, hi)) for a, b, lo, hi in zip(cuts, cuts[1:], ends, ends[1:])]
        params = [np.zeros((len(used), k)), np.zeros((DENSE + 1, k))]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        dense = np.hstack([f.dense, np.ones((n, 1))])
        for step in range(1, STEPS + 1):
            s = dense @ params[1]
            for at, own in parts:
                text = f.text[own] - at.start
                sums = [np.bincount(text, params[0][index[own], c], at.stop - at.start) for c in range(k)]
                s[at] += np.stack(sums, 1) * f.weight[at, None]
            s = np.exp(s - s.max(axis=1, keepdims=True))
            p = s / s.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            scaled = p * f.weight[:, None]
            grads = [DECAY * params[0] / n, dense.T @ p]
            for _, own in parts:
                for c in range(k):
                    grads[0][:, c] += np.bincount(index[own], scaled[f.text[own], c], len(used))
            for w, g, a, b in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-10)
        self.hashed[used] = params[0]
        self.dense = params[1]


def label_domain(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of labelled documents: toxic, else good or poor by quality; null labels count as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    domain = F.when(zero("toxic") > 0, "toxic").when(zero("quality") > 0, "good").otherwise("poor")
    return (labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"))
            .groupBy("doc_id").agg(F.max("domain").alias("domain")))


def fitted(docs: DataFrame, labelled: DataFrame) -> Classifier | None:
    """A classifier of ``domain``, fitted on about ``LABELLED`` documents of each domain at most; None without any.

    Only labels with a document that has a text count. They are drawn domain by domain, by a hash of their id,
    and the prior of each domain is then set right to its count before the draw. The drawn
    labels are few enough to be broadcast, so only the ids of the documents are shuffled.
    Of rows with one id, one is learned from.
    """
    present = docs.where("text is not null and doc_id is not null").select("doc_id").distinct()
    present = saved(labelled.join(present, "doc_id", "left_semi"), "labelled")
    counts = {r["domain"]: r["n"] for r in present.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, min(1.0, LABELLED / n))])[F.col("domain")]
    drawn = present.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    rows = docs.where("text is not null").join(F.broadcast(drawn), "doc_id").select("doc_id", "domain", "text")

    def extract(batches):
        for batch, data, offsets in words.pieces(batches):
            f = Features(data, offsets)
            at = np.searchsorted(f.text, np.arange(batch.num_rows + 1))
            index = [f.index[a:b].astype(np.int32).tobytes() for a, b in zip(at, at[1:])]
            yield pa.record_batch([batch.column("doc_id"), batch.column("domain"), pa.array(index, pa.binary()),
                                   pa.array([x.tobytes() for x in f.dense], pa.binary())], names=["doc_id", "domain", "words", "dense"])

    got = rows.mapInArrow(extract, "doc_id long, domain string, words binary, dense binary")
    got = got.groupBy("doc_id").agg(F.min(F.struct("domain", "words", "dense")).alias("r")).select("doc_id", "r.*").collect()
    got = sorted(got, key=lambda r: r["doc_id"])
    if not got:
        return None
    out = Classifier(sorted({r["domain"] for r in got}))
    f = Features.__new__(Features)
    sizes = [len(r["words"]) // 4 for r in got]
    f.index = np.frombuffer(b"".join(r["words"] for r in got), np.int32)
    f.text = np.repeat(np.arange(len(got), dtype=np.int32), sizes)
    f.dense = np.stack([np.frombuffer(r["dense"]) for r in got])
    f.weight, f.words = 1 / np.sqrt(np.maximum(sizes, 1)), np.array(sizes)
    y = np.array([out.domains.index(r["domain"]) for r in got])
    del got
    out.fit(f, y)
    prior = np.array([counts[d] for d in out.domains]) / np.bincount(y)
    out.dense[-1] += np.log(prior / prior.max())
    return out


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, n_tokens (words), p, the domain posteriors, and draw for every row of ``docs`` (doc_id, text)."""

    def score(batches):
        for batch, data, offsets in words.pieces(batches):
            f = Features(data, offsets)
            p = model.posteriors(f)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.reshape(-1)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(f.words.astype(np.int64)), lists, batch.column("draw")],
                                  names=["doc_id", "n_tokens", "p", "draw"])

    return docs.select("doc_id", "text", draw().alias("draw")).mapInArrow(score, "doc_id long, n_tokens long, p array<double>, draw double")


def draw() -> Column:
    """A number from 0 up to 1 by the hash of a row's doc_id and text."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))


def rate(history: list[list[float]]) -> Column:
    """The rate after the steps taken so far: each adds the product of ``p`` and a vector, and nothing falls below 0."""
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in m]) for m in history]) if history else F.expr("cast(array() as array<array<double>>)")
    dot = lambda m: F.aggregate(F.arrays_zip(F.col("p").alias("x"), m.alias("y")), F.lit(0.0), lambda a, z: a + z["x"] * z["y"])
    return F.aggregate(steps, F.lit(1.0), lambda r, m: F.greatest(F.lit(0.0), r + dot(m)))


def fit_rates(scored: DataFrame, expected: np.ndarray, targets: np.ndarray) -> list[list[float]]:
    """The step ``m`` from rates of 1 to those that bring the expected token totals of the domains to ``targets``.

    Minimises the distance of S to the targets, S[d] = sum of rate * tokens * p[d], over
    rates of 0 or more. The distance is least squares with each domain weighed by the inverse of its
    tokens at rates of 1 (``expected``), plus ``RIDGE`` times that of the rates from 1, so of the
    rates that do equally well those nearest to 1 are taken. Such rates are max(0, 1 + p m) for a
    vector m with a number per domain, the minimum of a smooth convex function with gradient
    S - targets + RIDGE * expected * m and, as second derivative, the Gram matrix of p over the documents
    above 0. A round is one aggregation over all documents to value, gradient and Gram matrix
    at several Newton steps from the best m so far, and at gradient steps, of which the one by
    1 / expected never overshoots. It ends when every domain is within ``CLOSE`` of all tokens,
    when no part of the gradient is over ``FLAT`` of them, or when numbers of 64 bits show no gain.
    """
    known = expected > 0
    if not known.any():
        return []
    k, total = len(targets), expected.sum()
    scale, goal = np.where(known, expected, 1), np.where(known, targets, 0)
    here, least, tries = None, np.inf, [np.zeros(k)]
    for _ in range(ROUNDS):
        n = 1 + k + k * k
        got = token_sums(scored, tries, k).agg(*[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(n * len(tries))]).first()
        got = np.array(got, float).reshape(len(tries), n)
        values = [g[0] - goal @ m + RIDGE / 2 * scale @ (m * m) for g, m in zip(got, tries)]
        best = int(np.argmin(values))
        if not values[best] < least:
            break
        least, here = values[best], tries[best]
        off = np.where(known, got[best, 1:k + 1] - goal, 0)
        slope = off + RIDGE * scale * here
        if np.abs(off).max() <= CLOSE * total or np.abs(slope).max() <= FLAT * total:
            break
        newton = np.linalg.solve(got[best, k + 1:].reshape(k, k) + np.diag(RIDGE * scale), -slope)
        tries = [here + x * newton for x in NEWTON] + [here - x * slope / scale / (1 + RIDGE) for x in GRADIENT]
    else:
        raise RuntimeError(f"the rates are not fitted after {ROUNDS} rounds")
    return [here.tolist()]


def token_sums(scored: DataFrame, tries: list[np.ndarray], k: int) -> DataFrame:
    """``s``: for each of ``tries``, half the tokens times squared rates, the expected tokens of the domains, and the Gram matrix.

    One row for each batch of documents; the Gram matrix is of p over the documents with a rate above 0, by tokens.
    """

    def add(batches):
        for batch in batches:
            if batch.num_rows:
                p = batch.column("p").flatten().to_numpy().reshape(-1, k)
                tokens, s = batch.column("n_tokens").to_numpy(), []
                for m in tries:
                    r = rates_of(p, [m])
                    s += [r @ (r * tokens) / 2, *((r * tokens) @ p), *(p.T @ (p * (tokens * (r > 0))[:, None])).reshape(-1)]
                yield pa.record_batch([pa.array([list(map(float, s))], pa.list_(pa.float64()))], names=["s"])

    return scored.select("n_tokens", "p").mapInArrow(add, "s array<double>")


#: The target shares of the query and the pipeline.
TARGETS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}


class Mix:
    """A fitted mix: the classifier, the posteriors of all documents, and the steps of the rates."""

    def __init__(self, docs: DataFrame, labelled: DataFrame, weights: dict[str, float], floor: str | None):
        self.model = fitted(docs, labelled)
        if self.model is None:
            return
        domains = self.model.domains
        self.scored = saved(posteriors(docs, self.model), "posteriors")
        w = np.array([weights.get(d, 0.0) for d in domains], float)
        w = w / w.sum() if w.sum() > 0 else np.full(len(w), 1 / len(w))
        expected = self.scored.agg(*[F.sum(F.col("n_tokens") * F.col("p")[d]).alias(f"e{d}") for d in range(len(w))]).first()
        expected = np.array([x or 0.0 for x in expected], float)
        at = domains.index(floor) if floor in domains else None
        budget = expected[at] / w[at] if at is not None and w[at] > 0 else expected.sum()
        self.steps = fit_rates(self.scored, expected, w * budget)


def rates_of(p: np.ndarray, steps: list[list[float]]) -> np.ndarray:
    """``rate`` in numpy."""
    r = np.ones(len(p))
    for m in steps:
        r = np.maximum(0.0, r + p @ np.array(m))
    return r


def mix_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGETS, floor: str | None = "good") -> DataFrame:
    """Rates for ``docs`` (doc_id, text) from ``labels`` (doc_id, quality, toxic): doc_id, n_tokens, domain, p, rate, copies.

    ``weights`` are the shares of tokens that the domains good, poor and toxic shall have;
    domains without a labelled document cannot be told apart and are left out, the others
    rescaled. The budget is all tokens, or, if ``floor`` names a domain, so many that this domain
    keeps its expected tokens. domain is the likeliest one, p the posteriors by name of the
    domain. copies is the whole part of the rate, and one more if a hash of doc_id and text falls below the
    rest, so that the tokens of all copies are those of the rates in expectation.

    Each row has a rate of its own, also null ids and repeated rows (rows equal in both columns get equal copies). A null or empty text has no
    tokens and moves nothing. Without any labelled document every rate is 1, and domain
    and p are null; empty tables give no rows. Columns other than those named are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mix = Mix(docs, label_domain(labels), weights, floor)
    if mix.model is None:
        return docs.select("doc_id", F.lit(None).cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("domain"),
                           F.lit(None).cast("array<double>").alias("p"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    names = F.array(*[F.lit(d) for d in mix.model.domains])
    likeliest = names[F.expr("cast(array_position(p, array_max(p)) - 1 as int)")]
    return (mix.scored.select("doc_id", "n_tokens", likeliest.alias("domain"), "p", rate(mix.steps).alias("rate"), "draw")
            .withColumn("copies", F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")).drop("draw"))


def remix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGETS, floor: str | None = "good") -> DataFrame:
    """``docs``, all columns, with each row as many times as ``mix_documents`` says (0 times: it goes).

    Rows are taken by their own hash, also null ids; repeated rows get equal copies, a null or empty text the rate of
    its posteriors. Without any labelled document all rows stay once; an empty table gives no rows. Columns may have any
    names.
    """
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mix = Mix(pairs, label_domain(labels), weights, floor)
    if mix.model is None:
        return docs
    model, steps = mix.model, mix.steps

    def repeat(batches):
        for batch, data, offsets in words.pieces(batches):
            rates = rates_of(model.posteriors(Features(data, offsets)), steps)
            copies = np.floor(rates).astype(int) + (batch.columns[-1].to_numpy() < rates - np.floor(rates))
            rows = pa.record_batch(batch.columns[:-1], names=batch.schema.names[:-1])
            yield rows.take(pa.array(np.repeat(np.arange(batch.num_rows), copies)))

    return docs.select("*", draw().alias("_".join(["draw", *docs.columns]))).mapInArrow(repeat, docs.schema)
