"""Each training-data operator against brute force, a round trip or its oracle, with nulls, ties, repeats and empty tables."""

import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from dexflow.llm import chats, decontam, embeddings, langid, minhash, mixing, queries, shards, substring, urls, warc, words

TEXT = "doc_id long, text string"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    got = rows(df, *columns)
    want = sorted((tuple(r) for r in duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()), key=repr)
    assert got == want


def test_word_hashes_do_not_depend_on_place():
    texts = [b"a bb a", b"", b"x" * 600_000 + b" bb", b"\xc3\xa9 bb\x0ba"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    w = words.Words(data, offsets)
    h = w.hashes()
    flat = [x for t in texts for x in WORDS.findall(t)]
    assert len(h) == len(flat)
    for i, a in enumerate(flat):
        for j, b in enumerate(flat):
            assert (h[i] == h[j]) == (a == b)


def test_warc_round_trip(spark):
    marker = "x WARC/1.1\r\nWARC-Type: response\r\n\r\n"
    data = [(1, "http://a/", "é" * 50_000), (2, None, None), (3, "u\r\nv", ""), (4, "http://b/", marker * 3), (5, "http://c/", "é" * 50_000),
            (None, "n", "é" * 50_000), (6, "s", "alone"), (6, "s", "alone")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("payload", F.lit("other"))
    got = warc.archive_round_trip(pages).drop("payload")
    digest = lambda s: warc.digest_of((s or "").encode())
    want = []
    for page, _, html in data:
        first = min((p for p, _, h in data if (h or "") == (html or "") and p is not None), default=None)
        many = sum((h or "") == (html or "") for _, _, h in data) > 1
        again = many and first is not None and page != first
        want.append((page, "revisit" if again else "response", first if again else None, digest(html), len((html or "").encode())))
    assert rows(got) == sorted(want, key=repr)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_warc_checks():
    block = warc.HTTP + b"".join(warc.chunked(b"abc" * 100, 7))
    part = lambda i, b, total=None: {"id": "r", "segment": i, "total": total, "block": b}
    cut = [part(2, block[90:], len(block)), part(1, block[:90])]
    assert warc.payload_of(cut) == b"abc" * 100
    for bad in ([cut[0]], [part(2, block[90:], 5), cut[1]], [cut[1], part(3, block[90:], len(block))]):
        with pytest.raises(ValueError):
            warc.payload_of(bad)


def brute_substring(docs, length):
    split = [(d, WORDS.findall((t or "").encode())) for d, t in docs]
    first = {}
    for d, w in split:
        for i in range(len(w) - length + 1 if d is not None else 0):
            key = tuple(w[i:i + length])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1 if d is not None else 0):
            if first[tuple(w[i:i + length])] < d:
                gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    docs = [(0, " ".join(base)), (None, " ".join(base)), (90, None), (91, ""), (92, " \t\x0b"), (93, "a b c")]
    for d in range(1, 60):
        parts = [f"v{rng.randrange(9999)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(330)
            parts += base[at:at + rng.choice([49, 50, 51, 55, 70, 120])] + [f"u{rng.randrange(9999)}"] * rng.randrange(3)
        docs.append((d, "  ".join(parts)))
    docs += [(7, docs[20][1]), (30, docs[36][1]), (30, docs[36][1]), (94, "z " * 300), (95, "z " * 60)]
    df = spark.createDataFrame(docs, TEXT).withColumn("place", F.lit(1))
    assert rows(substring.remove_repeats(df, 50)) == brute_substring(docs, 50)
    assert substring.remove_repeats(df.limit(0), 50).count() == 0


def brute_components(ids, linked):
    comp = list(range(len(ids)))
    while True:
        new = [min([comp[i], *(comp[j] for j in range(len(ids)) if linked[i][j])], key=lambda c: ids[c]) for i in range(len(ids))]
        if new == comp:
            return [ids[c] for c in comp]
        comp = new


@pytest.mark.parametrize("width", [2, 5])
def test_minhash(spark, width):
    rng = random.Random(width)
    docs = [(500, None), (501, ""), (502, "One"), (503, "one"), (None, "one")]
    for g in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(copy) // 8)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            docs.append((len(docs) + 7 * g, " ".join(copy)))
    docs += [(900, docs[9][1].upper()), docs[9]]

    def shingles(t):
        w = [x.lower() for x in WORDS.findall((t or "").encode())]
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}

    sets = [shingles(t) for _, t in docs]
    ids = [d for d, _ in docs]
    ok = [d is not None and len(s) > 0 for d, s in zip(ids, sets)]
    linked = [[ok[i] and ok[j] and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    order = [d if d is not None else 10**9 + i for i, d in enumerate(ids)]
    comp = brute_components(order, linked)
    want = [(d, len(s), c if d is not None else None, d is None or c == d) for d, s, c in zip(ids, sets, comp)]
    df = spark.createDataFrame(docs, TEXT).withColumn("cid", F.lit(0))
    assert rows(minhash.near_duplicates(df, width)) == sorted(want, key=repr)
    assert minhash.near_duplicates(df.limit(0), width).count() == 0
    kept = {r["doc_id"] for r in minhash.drop_near_duplicates(df, width).collect()}
    assert kept == {d for d, _, _, k in want if k}


def test_signatures_within_distance_share_a_chunk_key():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 9, minhash.VALUES)
        b = a.copy()
        b[rng.choice(minhash.VALUES, minhash.DISTANCE, replace=False)] += 100
        off = (a != b).reshape(minhash.CHUNKS, minhash.SLOTS).sum(axis=1)
        assert off.min() <= minhash.ERRORS


def test_embeddings(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((12, 16))
    data = [(i, [float(x) for x in base[i % 12] + 0.16 * rng.standard_normal(16)]) for i in range(120)]
    data += [(200, [0.0] * 16), (201, None), (202, [None] + [1.0] * 15), (203, [float("nan")] * 16), (204, [float("inf")] + [1.0] * 15),
             (205, [1.0, 0.0]), (206, [2.0, 0.0]), (None, data[0][1]), (3, data[3][1]), (300, [1e-200 * x for x in data[0][1]])]
    usable = lambda i, v: i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        return embeddings.exact_cosine(np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max())

    linked = [[i != j and usable(*a) and usable(*b) and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.9 for j, b in enumerate(data)]
              for i, a in enumerate(data)]
    order = [i if i is not None else 10**9 for i, _ in data]
    comp = brute_components(order, linked)
    want = sorted(((i, sum(row), c if i is not None else None, i is None or i == c) for (i, _), row, c in zip(data, linked, comp)), key=repr)
    monkeypatch.setattr(embeddings, "TILE", 32)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("size", F.lit("x"))
    assert rows(embeddings.near_vectors(df)) == want
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_urls(spark):
    rules = urls.rule_table(spark, queries.URL_RULES)
    data = [(1, "http://WWW.Example.com/en/x?q"), (2, "https://a.example.com/en/"), (3, "http://example.com/en"), (4, "http://b.net/fr/?a#b"),
            (5, "http://net/es/x"), (6, "http://xnet/es/x"), (7, None), (8, "no scheme"), (9, "http://a.com?x/"), (10, "http://a.com/" + "d/" * 5000),
            (10, "http://b.net/fr/?a#b"), (11, "ftp://é.com/\n/x"), (12, "http://com/")]
    got = rows(urls.judge_urls(spark.createDataFrame(data, "page_id long, url string").withColumn("rule", F.lit(0)), rules), "page_id", "rule", "verdict")
    want = [(1, "www.example.com/en/", "allow"), (2, "example.com/en/", "block"), (3, "com/", "allow"), (4, "net/fr/", "block"), (5, "net/es/", "block"),
            (6, None, "allow"), (7, None, "allow"), (8, None, "allow"), (9, None, "allow"), (10, "com/", "allow"), (10, "net/fr/", "block"),
            (11, "com/", "allow"), (12, "com/", "allow")]
    assert got == sorted(want, key=repr)
    with pytest.raises(ValueError):
        urls.judge_urls(spark.createDataFrame(data, "page_id long, url string"), urls.rule_table(spark, [("com/en", "block")]))
    none = urls.judge_urls(spark.createDataFrame(data[:1], "page_id long, url string"), urls.rule_table(spark, []))
    assert rows(none, "verdict") == [("allow",)]


def test_chats(spark, monkeypatch):
    monkeypatch.setattr(chats, "BLOCK", 3)
    conv = lambda i, *texts: [(i, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]
    data = conv(1, *"abcdefgh") + conv(2, *"abc") + conv(3, *"abcdefgh") + conv(4, *"abx") + conv(5, "a") + conv(None, "q", None) + [(6, None, None, "")]
    got = rows(chats.format_chats(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))),
               "conv_id", "n_turns", "copies")
    assert got == sorted([(1, 8, 2), (4, 3, 1), (None, 2, 1), (6, 1, 1)], key=repr)
    assert chats.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op6_url_filter", "op9_chat_format"):
        plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(shards, "FAN", 6)
    monkeypatch.setattr(shards, "BIN", 16)
    rng = random.Random(4)
    data = [(i, "é" * rng.randrange(400) + str(i % 80)) for i in range(300)] + [(None, None), (None, None), (400, ""), (401, None)]
    got = shards.shard_documents(spark.createDataFrame(data, TEXT).withColumn("size", F.lit(0))).collect()
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in data)
    by_text, loads, slots = {}, {}, {}
    for r in got:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        if r["text_crc32"] is not None:
            by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.shard_documents(spark.createDataFrame([], TEXT)).count() == 0


@pytest.mark.parametrize("share", [0.1, 1 / 3])
def test_shards_offset_a_large_group(spark, share):
    n = 2 * shards.FAN + 1
    sizes = [100 + i * 7919 % 901 for i in range(n)]
    sizes[5] = round(share / (1 - share) * (sum(sizes) - sizes[5]))
    groups = spark.createDataFrame([(hashlib.md5(b"%d" % i).digest(), s) for i, s in enumerate(sizes)], "key binary, size long")
    placed = {bytes(r["key"]): r["shard"] for r in shards.assign_groups(groups, 8).collect()}
    loads = [0] * 8
    for i, s in enumerate(sizes):
        loads[placed[hashlib.md5(b"%d" % i).digest()]] += s
    assert len(placed) == n
    total, others = sum(sizes), 1 / 8 if share < 1 / 8 else (1 - share) / 7
    assert abs(max(loads) / total - max(share, 1 / 8)) < 1e-3 and abs(min(loads) / total - others) < 1e-3


def test_difference_keeps_every_load():
    loads = [(5, 0, 0), (4, 1, 0), (7, 7, 7), (3, 0, 0)]
    to, total = shards.difference(loads)
    again = [0, 0, 0]
    for load, places in zip(loads, to):
        assert sorted(places) == [0, 1, 2]
        for slot, place in enumerate(places):
            again[place] += load[slot]
    assert again == total


def test_language_gradients():
    net = langid.Network(["a", "b"], seed=1)
    net.weights = [w.astype(np.float64) for w in net.weights]
    x, y = langid.padded([b"abc", b"xyz"]), np.array([0, 1])

    def loss():
        p, _ = net.positions(x)
        return -np.log(p[:, np.arange(2), y]).mean()

    for w, g in zip(net.weights, net.gradients(x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[at] += 1e-3
        up = loss()
        w[at] -= 2e-3
        assert abs((up - loss()) / 2e-3 - g[at]) < 2e-3
        w[at] += 1e-3


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "123 !", "en"), (None, "", None)], docs.schema).withColumn("score", F.lit(1))
    got = langid.identify_languages(docs.withColumn("score", F.lit(2)).unionByName(odd)).join(docs, "doc_id", "left").collect()
    held = [r for r in got if r["held_out"] and r["lang"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.9 * len(held)
    assert {(r["lang_pred"], r["score"]) for r in got if r["lang"] is None} == {("und", 0.0)}
    assert {r["lang_pred"] for r in langid.identify_languages(odd.drop("score")).collect()} == {"und"}
    assert langid.identify_languages(docs.limit(0)).count() == 0


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(i, " ".join(f"t{rng.randrange(5000)}" for _ in range(rng.choice([8, 20, 35, 60])))) for i in range(40)] + [(98, None), (99, "")]
    docs = [(500, None), (501, ""), (None, items[0][1])]
    for d in range(80):
        parts = [f"t{rng.randrange(5000)}" for _ in range(rng.randrange(200))]
        if d % 2:
            w = items[rng.randrange(40)][1].split()
            for _ in range(rng.randrange(1 + len(w) // 6)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(999)}"
            parts[len(parts) // 2:len(parts) // 2] = [x.upper() + "," for x in w]
        docs.append((d, " ".join(parts)))
    plain = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    want = set()
    for d, text in docs:
        ids = {}
        t = np.array([ids.setdefault(x, len(ids)) for x in plain(text)], int)
        for i, item in items:
            x = np.array([ids.setdefault(y, len(ids)) for y in plain(item)], int)
            if len(x) and decontam.best_match(x, t)[0] <= decontam.allowed(len(x)):
                want.add((d, i))
    df = spark.createDataFrame(docs, TEXT).withColumn("item_id", F.lit(1))
    got = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(df, empty).count() == 0 and decontam.decontaminate(df, empty).count() == len(docs)


def test_mixing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    odd = spark.createDataFrame([(None, None), (10**6, "")], TEXT)
    got = mixing.mix_documents(docs.unionByName(odd).withColumn("p", F.lit(1)), labels)
    truth = {r["doc_id"]: r["domain"] for r in mixing.label_domain(labels).collect()}
    r = got.collect()
    known = [x for x in r if x["doc_id"] in truth]
    assert sum(x["domain"] == truth[x["doc_id"]] for x in known) >= 0.9 * len(known)
    assert all(x["rate"] >= 0 for x in r) and len(r) == docs.count() + 2
    sums = np.array([[x["rate"] * x["n_tokens"] * p for p in x["p"]] for x in r]).sum(axis=0)
    assert np.abs(sums / sums.sum() - [0.9, 0.1, 0.0]).max() < 0.03
    assert {x["copies"] for x in mixing.mix_documents(docs, labels.limit(0)).collect()} == {1}
    assert mixing.mix_documents(docs.limit(0), labels).count() == 0


def overlapping(n):
    """Tokens and posteriors of good, poor and toxic documents, of which many could be either."""
    rng = np.random.default_rng(1)
    prior = np.array([0.76, 0.127, 0.113])
    x = rng.normal(size=(n, 3))
    x[np.arange(n), rng.choice(3, n, p=prior)] += 2
    p = np.exp(2 * x) * prior
    return rng.integers(20, 2000, n), p / p.sum(axis=1, keepdims=True)


def test_rates_are_fitted_to_the_optimum(spark):
    tokens, p = overlapping(20_000)
    scored = spark.createDataFrame([(int(t), list(map(float, x))) for t, x in zip(tokens, p)], "n_tokens long, p array<double>")
    expected = tokens @ p
    targets = np.array([0.9, 0.1, 0]) * expected[0] / 0.9
    r = mixing.rates_of(p, mixing.fit_rates(scored, expected, targets))
    off = (r * tokens) @ p - targets
    assert np.abs(off).max() < 1e-3 * expected.sum()
    slope = p @ (off / expected)
    assert np.where(r > 0, np.abs(slope), -slope).max() < 1e-4


@pytest.mark.parametrize("poor", [0.1, 0.4])
def test_copies_have_the_target_shares(spark, poor):
    rng = random.Random(6)
    kind = ["poor" if rng.random() < poor else "good" for _ in range(3000)]
    docs = [(i, " ".join(f"{k}{rng.randrange(50)}" for _ in range(rng.randrange(20, 40)))) for i, k in enumerate(kind)]
    df = spark.createDataFrame(docs, TEXT)
    labels = spark.createDataFrame([(i, int(k == "good"), 0) for i, k in enumerate(kind)], "doc_id long, quality int, toxic int")
    tokens, copies = {"good": 0, "poor": 0}, {}
    for r in mixing.remix(df, labels).collect():
        tokens[kind[r["doc_id"]]] += len(r["text"].split())
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert abs(tokens["poor"] / sum(tokens.values()) - 0.1) < 0.015
    assert {r["doc_id"]: r["copies"] for r in mixing.mix_documents(df, labels).collect() if r["copies"]} == copies


def test_rare_domain_is_learned(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LABELLED", 200)
    rng = random.Random(7)
    kind = ["toxic" if i % 500 == 7 else "poor" if i % 10 == 3 else "good" for i in range(4000)]
    docs = [(i, " ".join(f"{k}{rng.randrange(20)}" for _ in range(20))) for i, k in enumerate(kind)]
    labels = [(i, int(k == "good"), int(k == "toxic")) for i, k in enumerate(kind)] + [(i, 0, 0) for i in range(4000, 12_000)]
    df, truth = spark.createDataFrame(docs, TEXT), mixing.label_domain(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = mixing.fitted(df.unionByName(df), truth)
    assert model.domains == ["good", "poor", "toxic"]
    got = mixing.posteriors(df, model).collect()
    assert all(model.domains[int(np.argmax(r["p"]))] == kind[r["doc_id"]] for r in got)
    mean = np.mean([r["p"] for r in got], axis=0)
    assert np.abs(mean - [kind.count(d) / len(kind) for d in model.domains]).max() < 0.02


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF_SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        path = os.path.join(tmp_path, name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        before = {r["doc_id"] for r in now.select("doc_id").collect()}
        if name == "near_dedup":
            assert ids == {r["doc_id"] for r in minhash.near_duplicates(now, 5).where("kept").collect()}
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            assert before - ids == {r["doc_id"] for r in decontam.contaminated(now, bench).collect()}
        now = out
    assert rows(now, "doc_id", "size") == rows(corpus_pipeline.run(spark, SF_SMALL), "doc_id", "size")
