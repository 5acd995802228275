"""Periodic runs: all of them against a plain search, their digests, SQL, odd rows."""

import hashlib
import random
import time
import zlib

import brute
import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from stockroom.llm import periodic_runs as P
from stockroom.llm.registry import ORACLE
from stockroom.llm.shared import table

SF = "/root/testdata/sf0.01"


def plain_runs(x, least=12):
    """(start, end, period) by start, then period: every lag compared with every word."""
    seen = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            s = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, 2 * q):
                seen.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e, q) for (s, e), q in seen.items()), key=lambda r: (r[0], r[2]))


def sequence(rng):
    """Random words, planted repeats, rows of one word with breaks, halves that are runs, Fibonacci words."""
    k, n, kind = rng.choice([1, 2, 2, 3, 50]), rng.randint(0, 400), rng.randrange(6)
    x = [rng.randrange(k) for _ in range(n)]
    if kind == 1 and n:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 10)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    elif kind == 2:
        one, two = [0] * rng.randint(1, 60) + [1], ([0, 1] * 40)[:rng.randint(3, 80)]
        x = [w for _ in range(rng.randint(2, 8)) for w in rng.choice([one, one, two])]
    elif kind == 3:
        half = ([0, 1, 2][:rng.randint(1, 3)] * 100)[:rng.randint(20, 200)]
        x = half + half + [rng.randrange(2)] + half
    elif kind == 4:
        a, b = [0], [1]
        for _ in range(rng.randint(5, 10)):
            a, b = a + b, a
        x = a
    return x


@pytest.mark.parametrize("seed", range(8))
def test_all_runs_of_sequences(seed):
    rng = random.Random(seed)
    for _ in range(60):
        x = sequence(rng)
        got = P.find_runs(P.mix(np.array(x, dtype=np.uint64) + np.uint64(9)), len(x))
        assert [tuple(r) for r in got.tolist()] == plain_runs(x), x


def plain(doc_id, text, plant=True):
    w = brute.words(text)
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    top = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    best = (None,) * 4 if top is None else (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2])
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_table_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", SF):
        ok, why = compare(P.op13_periodic_runs(spark, sf), ORACLE["op13_periodic_runs"], duck(sf))
        assert ok, why


def test_table_matches_plain_version(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    got = P.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == plain(r["doc_id"], texts[r["doc_id"]])


REPEATS = ["na " * 30, "a b c " * 20 + "stop here", "x\ty\nx y  x y x\x0by x y x y x y end", "one " * 11, "one " * 12, ("a " * 30 + "b ") * 6,
           "start " + "p q r s t " * 3, "é ü " * 9, "w" * 5000 + " " + "z " * 400]


def test_odd_rows(spark):
    rows = [*enumerate(brute.ODD + REPEATS), (None, "na " * 40), (None, None), (3, "a b " * 10), (3, "a b " * 10)]
    docs = brute.documents(spark, rows).withColumn("period", F.lit("x")).withColumn("id", F.lit(1))
    for plant in (False, True):
        got = P.runs_of(docs, plant=plant).collect()
        assert sorted(tuple(map(str, r)) for r in got) == sorted((str(i), *map(str, plain(i, t, plant))) for i, t in rows)
    assert P.runs_of(docs.limit(0)).count() == 0 and P.collapse(docs.limit(0)).count() == 0


def test_small_batches_change_nothing(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert sorted(P.runs_of(docs, plant=True, limit=3000).collect()) == sorted(P.runs_of(docs, plant=True).collect())


def test_collapse_keeps_texts_without_runs(spark):
    docs = brute.documents(spark, [(1, "keep  this\ttext "), (2, "say " + "it again " * 8 + "now"), (3, None)]).withColumn("__x", F.lit(5))
    got = {r["doc_id"]: r for r in P.collapse(docs).collect()}
    assert [got[i]["text"] for i in (1, 2, 3)] == ["keep  this\ttext ", "say it again now", None]
    assert got[2]["__x"] == 5 and P.collapse(docs).columns == docs.columns


def test_time_follows_the_words():
    """Eight times the words take far less than 64 times the CPU time, also where nothing but repeats is there."""
    for unit in (b"a ", b"a " * 700 + b"b ", b"a b " * 500 + b"a "):
        took = []
        for n in (100_000, 800_000):
            text = (unit * (n // len(unit) + 1))[:n]
            took.append(min(timed(text) for _ in range(2)))
        assert took[1] < 32 * max(took[0], 0.05)


def timed(text):
    began = time.thread_time()
    P.digests(P.Scanned([text]))
    return time.thread_time() - began
