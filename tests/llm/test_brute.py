"""Whole results of the fitted operators against plain versions: language by a loop, sharding by plain differencing, rates by plain descent."""

import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow.llm import langid, mixing, shards
from test_operators import TEXT


def test_language_probabilities_equal_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").where("doc_id < 40")
    net = langid.trained(langid.draw_examples(docs, documents=10, segments=20))
    long = "ab" * 100 + " Wörter und words " * 50
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900, long), (901, long), (902, "12 34"), (903, None)], TEXT))
    for r in langid.predict(rows, net).collect():
        sums, n = np.zeros(len(net.languages)), 0
        for word in (r["text"] or "").encode().split():
            for i in range(0, len(word), langid.SEGMENT):
                p = net.positions(langid.padded([word[i:i + langid.SEGMENT]]))[0]
                sums, n = sums + p.sum(axis=(0, 1)), n + p.shape[0]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == net.languages[int(np.argmax(sums))]
            assert abs(r["score"] - sums.max() / n) < 1e-4


def plain_differencing(sizes, k):
    """The loads of ``k`` shards by repeatedly combining the two partial partitions with the largest spread."""
    parts = [sorted([s] + [0] * (k - 1), reverse=True) for s in sizes]
    order = list(range(len(parts)))
    while len(order) > 1:
        order.sort(key=lambda i: (min(parts[i]) - max(parts[i]), i))
        a, b = parts[order[0]], parts[order[1]]
        parts.append(sorted((x + y for x, y in zip(sorted(a, reverse=True), sorted(b))), reverse=True))
        order = order[2:] + [len(parts) - 1]
    return sorted(parts[order[0]])


def test_shards_equal_plain_differencing(spark):
    rng = random.Random(8)
    texts = ["x" * rng.randrange(1, 4000) + str(i) for i in range(150)]
    docs = [(i, rng.choice(texts[:20]) if i % 3 == 0 else rng.choice(texts)) for i in range(400)] + [(500, None), (501, ""), (502, "y" * 90_000)]
    got = shards.shard_documents(spark.createDataFrame(docs, TEXT)).collect()
    groups = {}
    for i, t in docs:
        key = t if t is not None else i
        groups[key] = groups.get(key, 0) + len((t or "").encode()) + 1
    loads = [0] * 8
    for r in got:
        loads[r["shard"]] += r["size"]
    # Loads do not depend on which of two equal spreads goes first, but for ties; sizes here have none.
    want = plain_differencing([groups[k] for k in sorted(groups, key=str)], 8)
    assert sorted(loads)[-1] == want[-1] and sum(loads) == sum(want)
    assert max(abs(a - b) for a, b in zip(sorted(loads), want)) <= 0.01 * sum(want)
    by_text = {}
    for r, in zip(got):
        by_text.setdefault(dict(docs).get(r["doc_id"]) or r["doc_id"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_rates_equal_plain_descent(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([2.0, 0.7, 0.4], 300)
    tokens = rng.integers(5, 500, 300)
    expected = tokens @ p
    targets = np.array([0.9, 0.1, 0.0]) * expected[0] / 0.9

    def value(r):
        off = (r * tokens) @ p - targets
        return (off * off / expected).sum() / 2 + mixing.RIDGE / 2 * (tokens * (r - 1) ** 2).sum()

    # Accelerated descent with a projection, on the 300 rates themselves, in units of the root of the tokens.
    w = np.sqrt(tokens)
    a = (p * w[:, None]) / np.sqrt(expected)
    step = 1 / (np.linalg.eigvalsh(a.T @ a).max() + mixing.RIDGE)
    z = last = w.copy()
    for i in range(60_000):
        slope = a @ (a.T @ z - targets / np.sqrt(expected)) + mixing.RIDGE * (z - w)
        now = np.maximum(0.0, z - step * slope)
        z, last = now + i / (i + 3) * (now - last), now
    scored = spark.createDataFrame([(int(t), list(map(float, x))) for t, x in zip(tokens, p)], "n_tokens long, p array<double>")
    fitted = mixing.rates_of(p, mixing.fit_rates(scored, expected, targets))
    assert value(fitted) <= value(last / w) + 1e-6 * expected.sum()
    off = np.abs((fitted * tokens) @ p - targets).max()
    assert off <= np.abs(last * w @ p - targets).max() + 1e-4 * expected.sum()
