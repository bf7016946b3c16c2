"""The quality classifier: held-out accuracy, walks of the flat arrays against plain recursion, and odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from dexflow.llm import quality

DOCS = "doc_id long, text string"


def plain_walk(trees, row):
    total = trees.start
    for at in trees.roots:
        while trees.left[at] != at:
            at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        total += trees.value[at]
    return 1 / (1 + np.exp(-total))


def some_data(n=600):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 4))
    x[:, 3] = rng.integers(0, 3, n)  # ties
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0) | (x[:, 3] == 2)).astype(int)
    return x, y


def test_walk_equals_recursion_and_fits():
    x, y = some_data()
    trees = quality.fitted(x, y, np.ones(len(y)))
    got = trees.scores(x)
    assert np.allclose(got, [plain_walk(trees, r) for r in x])
    assert ((got > 0.5) == y).mean() > 0.95
    assert len(trees.scores(x[:0])) == 0


def test_best_split_equals_brute_force():
    x, y = some_data(200)
    edges = quality.bin_edges(x)
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    node = np.where(x[:, 0] > 1, -1, (x[:, 1] > 0).astype(int))
    g, h = 0.5 - y, np.full(len(y), 0.25)
    gains, features, cuts = quality.best_splits(bins, node, 2, g, h)
    value = lambda m: g[m].sum() ** 2 / (h[m].sum() + quality.SHRINK)
    for k in range(2):
        best = 0
        for f in range(4):
            for cut in range(quality.BINS):
                low, high = (node == k) & (bins[:, f] <= cut), (node == k) & (bins[:, f] > cut)
                if min(h[low].sum(), h[high].sum()) >= quality.LEAST:
                    best = max(best, value(low) + value(high) - value(node == k))
        assert np.isclose(gains[k], best)
        assert np.isclose(gains[k], value((node == k) & (bins[:, features[k]] <= cuts[k])) + value((node == k) & (bins[:, features[k]] > cuts[k]))
                          - value(node == k))


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b" \n", "Éa B!! B!! ###\nOne, two.\nOne, two.".encode(), b"x" * 5000, b"a b c\n" * 400]
    cut = lambda ts: quality.statistics_of(np.frombuffer(b"".join(ts), np.uint8), np.cumsum([0, *map(len, ts)]))
    together = cut(texts)
    assert np.isfinite(together).all()
    for i, t in enumerate(texts):
        assert np.allclose(together[i], cut([t])[0])
    named = dict(zip(quality.FEATURES, together[2]))
    assert named["distinct_lines"] == pytest.approx(2 / 3) and named["all_upper"] == 0 and named["sign_words"] == pytest.approx(1 / 8)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score_quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert found.count() > 30 and right >= 0.97


def test_odd_rows(spark):
    good, bad = "The cat sat on the mat. It was late.\n", "CAT!! MAT!! $$$ THE!!\n"
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5)) for i in range(80)]
    labels = [(i, i % 2) for i in range(80)] + [(None, 1), (7, None), (900, 1), (3, 0), (3, 1)]
    extra = [(None, good), (500, None), (501, ""), (502, good), (502, good), (1, good * 2), (503, good * 20_000)]
    docs = spark.createDataFrame(rows + extra, DOCS).withColumn("x", F.lit(1)).withColumn("score", F.lit("other"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("y", F.lit(3))
    got = quality.score_quality(docs, marks).collect()
    assert len(got) == len(rows + extra)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    assert len({r["score"] for r in got if r["doc_id"] == 502}) == 1
    assert len({r["score"] for r in got if r["doc_id"] in (500, 501)}) == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 80)
    assert quality.score_quality(docs.limit(0), marks).count() == 0
    assert {r["score"] for r in quality.score_quality(docs, marks.limit(0)).collect()} == {0.5}
    one = quality.score_quality(docs, marks.where("quality = 1")).collect()
    assert all(r["score"] > 0.99 for r in one)
