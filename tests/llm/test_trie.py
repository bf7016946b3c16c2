"""The prefix trie against a plain trie of dictionaries, with segments and blocks of all sizes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dexflow.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def brute(data):
    own = {}
    for conv, turn, role, text in data:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = (*own.get(c - int(np.fmod(c, 100)), [])[:h], *turns[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        yield p
        for k in kids.get(p, []):
            yield from below(k)

    out = []
    for p, m in members.items():
        tree = list(below(p))
        ends = ",".join(str(c) for c in sorted(m) if len(full[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), sum(q not in kids for q in tree),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in tree if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed):
    rng, data = random.Random(seed), []
    for conv in [*range(100), 200, 205, 207, 300, 317, 1003, -5, -100, -120]:
        for i in range(rng.choice([1, 1, 2, 3, 4, 7, 9])):
            text = rng.choice(["a", "b", "é\U0001f600", "", None]) if rng.random() < 0.8 else f"t{rng.randrange(9999)}"
            data.append((conv, rng.choice([i, i, None, 1]), rng.choice(["user", "assistant", None]), text))
    data += [(c, i, "user", "same") for c in range(400, 430) for i in range(9)]
    data += [(500, i, "user", str(i % 3)) for i in range(150)] + [(501, i, "user", str(i % 3)) for i in range(140)]
    return data + [(None, 1, "user", "nobody"), data[3], data[3]]


@pytest.mark.parametrize("segment, block", [(2, 3), (5, 16), (trie.SEGMENT, trie.BLOCK)])
def test_trie_equals_brute_force(spark, monkeypatch, segment, block):
    for name, value in (("SEGMENT", segment), ("BLOCK", block), ("DEPTHS", 7)):
        monkeypatch.setattr(trie, name, value)
    data = made(block)
    df = spark.createDataFrame(data, TURNS).withColumn("token", F.lit("other")).withColumn("depth", F.lit(1)).repartition(6)
    got = sorted((tuple(r) for r in trie.trie_report(df).collect()), key=repr)
    assert got == brute(data)


def test_empty(spark):
    df = spark.createDataFrame([], TURNS)
    assert trie.trie_report(df).count() == 0
    assert trie.trie_report(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


def test_extents_equal_a_plain_search():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64, 100):
        common = rng.integers(0, 5, n)
        common[0] = -1
        rows, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        left, right = trie.extents(common, rows, depth)
        for i, d, a, b in zip(rows, depth, left, right):
            lo = hi = i
            while lo and common[lo] >= d:
                lo -= 1
            while hi + 1 < n and common[hi + 1] >= d:
                hi += 1
            assert (a, b) == (lo, hi)
        values = rng.integers(0, 100, n)
        assert [values[a:b + 1].min() for a, b in zip(left, right)] == list(trie.range_least(trie.sparse_table(values), left, right))
