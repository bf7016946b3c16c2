"""Crafted input: words that sums of powers cannot tell apart, pages that end in a version line, corpora without labels, odd rows and names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from dexflow.llm import decontam, langid, minhash, mixing, substring, urls, warc, words
from helpers import plan_text
from test_operators import TEXT, brute_substring, rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") % 2] for i in range(n)]


ONE, TWO = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))


def test_word_hashes_tell_thue_morse_words_apart():
    data = np.frombuffer(f"{ONE} {TWO} {ONE}{TWO} {TWO}{ONE}".encode(), np.uint8)
    assert len(set(words.Words(data, np.array([0, len(data)])).hashes())) == 4


def test_minhash_and_substring_tell_thue_morse_words_apart(spark):
    docs = [(1, ONE), (2, TWO), (3, ONE)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, TEXT), 5).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    rest = " ".join(f"w{i}" for i in range(49))
    docs = [(1, f"{ONE} {rest}"), (2, f"{TWO} {rest}"), (3, f"{ONE} {rest}")]
    assert rows(substring.remove_repeats(spark.createDataFrame(docs, TEXT), 50)) == brute_substring(docs, 50)


def test_pages_that_end_in_a_version_line(spark):
    end = "WARC/1.1"
    data = [(1, "u", f"page ends in {end}"), (2, f"http://a/{end}", "x"), (3, "u", "y" * (8192 - 8) + end + "z" * 50), (4, "u", end), (5, "u", end * 3)]
    # The end of a segment, wherever the framing puts it.
    data += [(10 + i, "u", "y" * (32768 - i) + end + "z" * 40_000) for i in range(60, 130)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r["page_id"]: (r["payload_digest"], r["payload_bytes"]) for r in warc.archive_round_trip(pages).collect()}
    assert got == {p: (warc.digest_of(h.encode()), len(h)) for p, _, h in data}


def test_segments_never_end_in_a_version_name():
    block = b"abcWARC/1.1defWARC/1.1" * 5 + b"0"
    for size in range(5, 60):
        parts = list(warc.segments_of(block, size))
        assert b"".join(parts) == block and not any(p.endswith(warc.NAME) for p in parts)
        framed = b"".join(warc.chunked(block, size))
        assert warc.VERSION not in framed and warc.dechunked(framed) == block


def test_broken_records_are_value_errors():
    for bad in (b"WARC-Type: response\r\n\r\nbody", b"junk", b""):
        with pytest.raises(ValueError):
            warc.parsed(bad)


ODD = [(None, "Some words of a text.", None, None, None), (900, None, "en", "s", 0), (901, "", None, "s", 0), (902, "1 2 3", "en", None, 5),
       (903, "A text that comes twice.", "en", "s", 3), (903, "A text that comes twice.", "en", "s", 3)]


def test_no_labels_reject_no_language(spark):
    docs = spark.createDataFrame([(i, f"some words {i}", None, "s", 1) for i in range(200)] + ODD[:1], DOCS)
    assert langid.keep_identified(docs).count() == 201
    assert langid.keep_identified(spark.createDataFrame(ODD, DOCS).withColumn("lang", F.lit(None).cast("string"))).count() == 3
    assert langid.keep_identified(docs.limit(0)).count() == 0


def test_one_row_of_an_id_is_learned_from(spark):
    docs = spark.createDataFrame([(1, "the text", "en")] * 300 + [(3, "der Text", "de")], "doc_id long, text string, lang string")
    assert len(langid.draw_examples(docs)) <= 2


def test_drop_near_duplicates_with_odd_rows_and_names(spark):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(999)}" for _ in range(40)) for _ in range(6)]
    data = [(i, base[i % 6] + " x" * (i // 6), "en", "s", i) for i in range(18)] + ODD + [(30, base[0], "en", "s", 0), (30, "another text altogether", "en", "s", 0)]
    docs = spark.createDataFrame(data, DOCS).withColumns({"gone_id": F.lit(1), "again_id": F.lit(2), "kept": F.lit(3), "rows": F.lit(4)})
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    kept = {r["doc_id"] for r in minhash.near_duplicates(docs).where("kept").collect()}
    want = {(r[0], r[1]) for r in data if r[0] is None or r[0] in kept}
    assert len(got) == len(set(got)) and set(got) == want
    assert minhash.drop_near_duplicates(docs.limit(0)).count() == 0
    bench = spark.createDataFrame([(1, "another text altogether")], "item_id long, text string")
    clean = decontam.decontaminate(docs.withColumnRenamed("kept", "item_id"), bench)
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in data} - {30}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.remix(docs, labels).count() == len(data)


def test_groups_of_many_blocks_and_strips_lose_no_link(spark, monkeypatch):
    """One hot group: a passage that all texts share, with chains of texts at the edge of a link."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "ASKERS", 3)
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(40)]
    docs = [(i, " ".join(shared + [f"w{rng.randrange(30)}" for _ in range(rng.randrange(2, 14))])) for i in range(90)]
    sets = {i: {(a, b) for a, b in zip(t.split(), t.split()[1:])} for i, t in docs}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, TEXT), 2).collect()}
    assert got == {i: root(i) for i in sets} and 1 < len(set(got.values())) < len(docs)


def test_every_row_outside_home_meets_every_member_once(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "ASKERS", 4)
    df = spark.createDataFrame([(i, 7, 0 if i < 30 else i % 3 + 1) for i in range(60)], "cid long, key long, cluster long")
    homes = minhash.homes(df, "key", "cluster")
    placed = minhash.dealt(df, homes, "key", "cluster").collect()
    h = homes.first()
    assert (h["home"], h["blocks"], h["strips"]) == (0, 12, 8)
    met = [(a["cid"], m["cid"]) for a in placed if a["asks"] for m in placed
           if not m["asks"] and (m["block"], m["strip"]) == (a["block"], a["strip"])]
    assert sorted(met) == [(a, m) for a in range(30, 60) for m in range(60)]


def test_classes_beyond_the_walks_are_searched_whole(monkeypatch):
    rng = np.random.default_rng(3)
    items = [(i, rng.integers(1 << 62, size=n).astype(words.U)) for i, n in enumerate((20, 22, 40, 45))]
    parts = [decontam.edited(x, decontam.allowed(len(x)), rng) for _, x in items for _ in range(25)]
    parts = [np.concatenate([rng.integers(1 << 62, size=30).astype(words.U), p]) for p in parts]
    hashes, first = np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])
    want = {(t, i) for t, p in enumerate(parts) for i, x in items if decontam.best_match(x, p)[0] <= decontam.allowed(len(x))}
    monkeypatch.setattr(decontam, "MOST", 0)
    whole = decontam.Searcher(items)
    assert all(c.walks is None for c in whole.classes)
    assert {(t, i) for t, i, *_ in whole.matches(hashes, first)} == want and len(want) >= 100
    monkeypatch.undo()
    walked = decontam.Searcher(items)
    assert all(c.walks for c in walked.classes) and {(t, i) for t, i, *_ in walked.matches(hashes, first)} == want


def test_remix_with_a_column_of_the_draws_name(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumns({"_draw": F.lit(5), "rate": F.lit(1)})
    out = mixing.remix(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert out.columns == docs.columns and {r["_draw"] for r in out.collect()} == {5}


def test_url_hits_are_never_broadcast(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.com/") for i in range(50)], "page_id long, url string")
    out = urls.judge_urls(pages, urls.rule_table(spark, [("com/", "block")]))
    assert "BroadcastHashJoin" not in plan_text(out)
    assert {r["verdict"] for r in out.collect()} == {"block"}


def test_pipeline_with_odd_rows(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "documents":
            odd = spark.createDataFrame(ODD, DOCS).select(*[F.col(f.name).cast(f.dataType) for f in df.schema])
            df = df.unionByName(odd).withColumns({"gone_id": F.lit(1), "f1": F.lit("x"), "score": F.lit(0.5)})
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in out.collect()}
    assert ids & set(range(200)) and not ids & {900, 901, 902}
    empty = tmp_path / "empty"
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
