"""Spelling variants: words, near words, forms and roots against plain versions and SQL; the trie's cuts; odd rows."""

import collections
import random
import re
import zlib

import brute
import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from stockroom.llm import spelling_variants as S
from stockroom.llm.registry import ORACLE
from stockroom.llm.shared import table

SF = "/root/testdata/sf0.01"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, least=S.LEAST_LENGTH, least_count=S.LEAST_COUNT, every=S.EVERY):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least_count}


def distance_one(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1] == 1


def plain_forms(words):
    out, form = {}, {}
    for w, n in words.items():
        near = [o for o in words if abs(len(o) - len(w)) <= 1 and distance_one(w, o)]
        top = min(near, key=lambda o: (-words[o], o), default=None)
        form[w] = top if top is not None and words[top] >= S.RATIO * n else None
        out[w] = (form[w], n, len(near), words[form[w]] if form[w] else None)
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (out[w][0], root, *out[w][1:])
    return out


def got_forms(spark, words, **how):
    rows = S.forms(spark.createDataFrame(list(words.items()), "word string, n long"), **how).collect()
    assert len(rows) == len(words)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_table_matches_sql(spark):
    ok, why = compare(S.op12_spelling_variants(spark, SF), ORACLE["op12_spelling_variants"], duck(SF))
    assert ok, why


ODD = [*brute.ODD, "ÀÉÎ×÷ÿß Āāþ Œ" * 3, "Straße STRASSE straßes" * 5, "naïve-naïve'naïve_NAÏVE9naïves", "x" * 200 + " " + "x" * 199, "\xc3\x83Ā caffè́"]


@pytest.mark.parametrize("every", [1, 3, 199])
def test_words_of_odd_rows(spark, every):
    rows = [*enumerate(ODD), *[(10 + i, "colour color colours colores Colour " * 3) for i in range(5)], (None, "no identity here " * 6), (None, None), (2, "twice twiced " * 9)]
    docs = brute.documents(spark, rows).withColumn("word", F.lit("clash")).withColumn("id", F.lit(0))
    for limit in (20, 2 << 20):
        got = {r["word"]: r["n"] for r in S.frequent_words(docs, least_length=3, least_count=2, every=every, limit=limit).collect()}
        assert got == plain_words(rows, 3, 2, every)
    assert S.forms(S.frequent_words(docs.limit(0))).count() == 0


def test_words_flushed_early_add_up(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 50)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["word"]: r["n"] for r in S.frequent_words(docs, limit=20_000).collect()} == plain_words(rows)


def family(seed, size=110):
    """Words that are edits of one another, of few letters, with long ones, anagrams and every kind of count."""
    rng = random.Random(seed)
    words = {}
    stems = ["".join(rng.choice("aebt") for _ in range(rng.randint(6, 9))) for _ in range(8)] + ["bcdefgh", "z" * 70, "é" * 64, "ÿ×÷àéè"]
    while len(words) < size:
        w = list(rng.choice(stems + list(words)))
        for _ in range(rng.randint(0, 2)):
            i, kind = rng.randrange(len(w)), rng.randrange(4)
            if kind == 0:
                w.insert(i, rng.choice("aebtzé"))
            elif kind == 1 and len(w) > 6:
                del w[i]
            elif kind == 2:
                w[i] = rng.choice("aebtzé")
            else:
                w[i], w[0] = w[0], w[i]
        words["".join(w)] = rng.choice([5, 5, 6, 25, 30, 125, 700, 4000])
    return words


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_all_near_words(seed):
    words = family(seed)
    names, want = sorted(words), plain_forms(words)
    raw, n = [w.encode("latin-1") for w in names], np.array([words[w] for w in names])
    for leaf in (1, 5, 1000):
        found, best = [], np.zeros(0)
        vec = S.vectors(raw)
        order = np.lexsort(vec.T[::-1])
        pairs = {(int(i), int(order[j])) for a, b in S.leaves(vec[order], vec, leaf) for i, j in zip(a, b)}
        found = {(i, j) for i, j in pairs if distance_one(names[i], names[j])}
        assert found == {(i, j) for i, w in enumerate(names) for j, o in enumerate(names) if distance_one(w, o)}
    count, best = S.search(raw, n, raw)
    for w, c, b in zip(names, count.tolist(), best.tolist()):
        near = [o for o in names if distance_one(w, o)]
        assert c == len(near) == want[w][3]
        assert (names[b] if b >= 0 else None) == min(near, key=lambda o: (-words[o], o), default=None)


@pytest.mark.parametrize("how", [{"subtrie": 20, "queries": 30, "step": 3}, {"subtrie": 2, "queries": 6, "step": 9}])
def test_cuts_and_blocks_lose_no_link(spark, how):
    words = family(11, 70)
    assert got_forms(spark, words, **how) == plain_forms(words)


def test_vectors_are_the_same_in_sql(spark):
    words = list(family(5, 60))
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, word string").select("i", S.counts_of().alias("v")).collect()
    assert [r["v"] for r in sorted(rows)] == S.vectors([w.encode("latin-1") for w in words]).tolist()


def test_long_chain_of_forms(spark):
    words = {"a" * (6 + i): 5 * 5 ** i for i in range(12)}
    got = got_forms(spark, words)
    assert got == plain_forms(words) and {v[1] for v in got.values()} == {"a" * 17}


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 4000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 3000, 300))
    ends = starts + rng.integers(1, 150, 300)
    before = rng.integers(0, 2**32, 300).astype(np.uint32)
    want = [zlib.crc32(raw[s:e].tobytes(), int(b)) for s, e, b in zip(starts, ends, before)]
    assert S.crc_after(before, raw, starts, ends).tolist() == want
