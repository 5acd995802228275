"""Byte CNN (held-out accuracy, whole texts) and the URL language models (SQL, plain version)."""

import collections
import math
import zlib

import brute
import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from stockroom.llm import byte_cnn, url_filter
from stockroom.llm.shared import table

SF = "/root/testdata/sf0.01"


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = byte_cnn.op7_byte_cnn(spark, sf).join(table(spark, sf, "labels"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() >= 0.99 and (bad.predicted == 0).mean() >= 0.85
    order = held.score.rank()
    auc = (order[held.quality == 1].sum() - len(good) * (len(good) + 1) / 2) / (len(good) * len(bad))
    assert auc >= 0.97


def test_long_texts_are_learned_and_scored_whole(spark):
    sf = "/root/testdata/sf0.1"
    got = byte_cnn.op7_byte_cnn(spark, sf).join(table(spark, sf, "labels"), "doc_id").join(
        table(spark, sf, "documents").filter("octet_length(text) > 14400").select("doc_id"), "doc_id").filter("held_out").collect()
    assert len(got) >= 5 and sum((r["predicted"] == 1) == (r["quality"] == 1) for r in got) >= 0.8 * len(got)


def test_sample_is_bounded_by_bytes(spark, monkeypatch):
    docs = brute.documents(spark, [(i, "word " * (20 if i % 3 else 400)) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(byte_cnn, "fit", lambda chunks, y, epochs: seen.append((sum(map(len, chunks)), len(y))))
    byte_cnn.train(docs, labels)
    byte_cnn.train(docs, labels, sample_bytes=3000)
    learned = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    assert seen[0] == (sum(len(byte_cnn.chunked([b"word " * (20 if i % 3 else 400)])[0]) for i in learned), len(learned))
    assert 10 <= seen[1][1] <= 30  # 100 bytes a row, or one of 2,000 and ten of 100


def test_chunks_cover_whole_texts():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(1, 256, n).astype(np.uint8)) for n in (0, 1, 63, 64, 65, 447, 448, 512, 513, 960, 961, 5000)]
    x, first = byte_cnn.chunked(texts)
    for i, t in enumerate(texts):
        seen = bytearray(len(t))
        for k, row in enumerate(x[first[i]:first[i + 1]]):
            at = k * byte_cnn.STRIDE
            piece = bytes(row)[:byte_cnn.CHUNK]
            assert piece.rstrip(b"\0") == t[at:at + byte_cnn.CHUNK].rstrip(b"\0")
            seen[at:at + byte_cnn.CHUNK] = b"\1" * len(t[at:at + byte_cnn.CHUNK])
        assert all(seen)


def test_score_is_the_plain_network():
    rng = np.random.default_rng(2)
    chunks = [byte_cnn.chunked([t])[0] for t in (b"abc " * 300, b"### $$$ " * 90, b"plain text. " * 20, b"%%% &&&" * 5)]
    model = byte_cnn.fit(chunks, np.array([1.0, 0, 1, 0]), epochs=2)
    text = bytes(rng.integers(32, 127, 1500).astype(np.uint8))
    x, _ = byte_cnn.chunked([text])
    pools = []
    for row in x:
        z = [sum(model["tables"][k][row[p + k]] for k in range(byte_cnn.WIDTH)) for p in range(byte_cnn.CHUNK)]
        pools.append(np.maximum(np.max(z, 0) + model["bias"], 0))
    v = np.concatenate([np.max(pools, 0), np.mean(pools, 0)])
    want = 1 / (1 + math.exp(-(v @ model["weights"] + model["shift"])))
    assert byte_cnn.score([b"x", text, b""], model)[1] == pytest.approx(want, abs=1e-5)


def test_classifier_with_odd_rows(spark):
    docs = brute.documents(spark, list(enumerate(brute.ODD)) + [(None, "no id"), (2, "twice")]).withColumn("score", F.lit("x")).withColumn("__y", F.lit(0))
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (3, 7), (None, 1), (5, 1), (5, 0), (6, 1)], "doc_id long, quality int")
    model = byte_cnn.train(docs, labels, epochs=1)
    got = byte_cnn.classify(docs, model).collect()
    assert len(got) == len(brute.ODD) + 2 and all(0 <= r["score"] <= 1 for r in got)
    kept = byte_cnn.keep(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["predicted"])
    one_class = byte_cnn.train(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in byte_cnn.classify(docs, one_class).collect()} == {1.0}
    nothing = byte_cnn.train(docs.limit(0), labels.limit(0))
    assert {r["score"] for r in byte_cnn.classify(docs, nothing).collect()} == {0.5}
    assert byte_cnn.classify(docs.limit(0), nothing).count() == 0


def test_urls_match_sql(spark):
    for sf in ("/root/testdata/sf0.001", SF):
        ok, why = compare(url_filter.op9_url_filter(spark, sf), url_filter.ORACLE, duck(sf))
        assert ok, why


def test_urls_run_without_python(spark):
    plan = url_filter.op9_url_filter(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


URLS = [None, "", "no scheme.com/a", "http://", "http://X.COM", "http://x.com?q=/en/", "HTTPS://A.Example.COM/en/1", "x://www.example.com/en/",
        "x://b.www.example.com/en/y#f", "x://example.com/en", "x://notexample.com/en/", "x://a.net/es/1", "x://a.net/esx", "x://net/fr/",
        "x://u:p@h.org:80/p/q?r#s", "a://b.com/://c", "x://é.com/", "x://" + "y" * 5000 + ".org/", "x://a.net/es/1"]


def test_odd_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "x://z.com/"), (3, "x://a.net/fr/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("score", F.lit(1))
    got = sorted(url_filter.judge(pages).collect(), key=lambda r: str(tuple(r)))
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got if r["page_id"] is not None}
    split = {i: (by[i]["host"], by[i]["path"], by[i]["rule"]) for i in by if i != 3}
    assert split[0] == split[1] == split[2] == ("", "", None)
    assert split[4] == ("x.com", "", None) and split[5] == ("x.com", "", None)
    assert split[6] == ("a.example.com", "/en/1", "example.com/en/") and split[7][2] == "www.example.com/en/" and split[8][2] == "www.example.com/en/"
    assert split[9][2] == "com/" and split[10][2] == "com/" and split[11][2] == "net/es/" and split[12][2] is None and split[13][2] == "net/fr/"
    assert split[14] == ("u:p@h.org:80", "/p/q", None) and split[15] == ("b.com", "/://c", "com/") and split[16][0] == "é.com"
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_ratio_is_witten_bell(spark):
    grams = collections.Counter()
    texts = {"allow": ["abcab", "abc"], "block": ["xbcx", "bcbc"]}
    for k, ts in texts.items():
        for t in ts:
            p = url_filter.PAD + t
            for i in range(len(t)):
                grams[(p[i:i + 5], k)] += 1
    names = sorted({g for g, _ in grams})
    got = {r["gram"]: r["ratio"] for r in url_filter.gram_ratio(spark.createDataFrame(
        [(g, grams[(g, "allow")], grams[(g, "block")]) for g in names], "gram string, allow long, block long")).collect()}

    def p(gram, k):
        low = 1 / 256
        for n in range(5):
            context, char = gram[4 - n:4], gram[4]
            after = collections.Counter()
            for (g, kind), c in grams.items():
                if kind == k and g[4 - n:4] == context:
                    after[g[4]] += c
            total, kinds = sum(after.values()), sum(c > 0 for c in after.values())
            if total:
                low = (after[char] + kinds * low) / (total + kinds)
        return low

    for g in names:
        assert got[g] == pytest.approx(math.log(p(g, "allow")) - math.log(p(g, "block")))
