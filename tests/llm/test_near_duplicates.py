"""N-gram Jaccard join and spherical-cap filters against comparing all pairs."""

import collections
import itertools
import os
import random

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm import ngram_jaccard, spherical_caps
from stockroom.llm.components import components
from stockroom.llm.shared import table

SF = "/root/testdata/sf0.01"


def jaccard(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect()), key=str)


def expected(rows):
    out = brute.jaccard_links(rows)
    return sorted(((i, out[k][1] if brute.words(t) else i, out[k][0]) for k, (i, t) in enumerate(rows)), key=str)


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7), (-5, -6)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(260)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = collections.defaultdict(set)
    for a, b in links:
        if a != b:
            near[a].add(b), near[b].add(a)
    for node in near:
        seen, stack = {node}, [node]
        while stack:
            for v in near[stack.pop()] - seen:
                seen.add(v), stack.append(v)
        assert got[node] == min(seen)
    assert got.keys() == near.keys()
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_over_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    want = expected(rows)
    assert sum(r[2] for r in want) > 100
    assert jaccard(ngram_jaccard.op2_ngram_jaccard(spark, SF)) == want


def near_copies(rng, n, length, edits):
    base = [str(rng.randrange(10 ** 6)) for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(length)] = "x" + str(rng.random())
        out.append(" ".join(w))
    return out


def test_jaccard_with_odd_rows_and_groups(spark):
    rng = random.Random(2)
    texts = [*brute.ODD, "a b c d", "a b c d", "a  b\nc\td", "one", "one", *near_copies(rng, 60, 120, 4), *near_copies(rng, 5, 40, 1), *[t + " tail" for t in near_copies(rng, 3, 300, 9)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[20]), (None, "only here " * 5), (5, texts[21]), (5, texts[21]), (6, "z y x w v u t s")]
    docs = brute.documents(spark, rows).withColumn("c", F.lit("clash")).withColumn("g", F.lit(1)).repartition(6)
    assert jaccard(ngram_jaccard.links(docs)) == expected(rows)
    assert ngram_jaccard.links(brute.documents(spark, [])).count() == 0


def test_jaccard_of_near_copies_without_ids(spark):
    rng = random.Random(9)
    one_side, both, many = (near_copies(rng, 8, 100, 1) for _ in range(3))
    rows = [(i if i < 3 else None, t) for i, t in enumerate(one_side)] + [(None, t) for t in both] + [(None, t) for t in many * 3] + [(40, many[0]), (41, "alone " * 9)]
    want = expected(rows)
    assert sum(r[1] is None and r[2] > 0 for r in want) >= 6
    docs = brute.documents(spark, rows).repartition(5)
    assert jaccard(ngram_jaccard.links(docs)) == want
    stay = sorted(((r["doc_id"], r["text"]) for r in ngram_jaccard.keep_one(docs).collect()), key=str)
    assert [i for i, _ in stay] == [0, 40, 41, None] and stay[3][1] in both


def test_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(3)
    rows = list(enumerate(near_copies(rng, 150, 100, 5) + near_copies(rng, 30, 80, 2)))
    docs = brute.documents(spark, rows)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_CLASSES", 16)
    assert jaccard(ngram_jaccard.links(docs)) == expected(rows)


def test_keep_one_of_each_group(spark):
    rng = random.Random(4)
    texts = [*near_copies(rng, 12, 60, 1), "", None, "", "alone in the world with these words", "copy of this one here", "copy of this one here"]
    rows = [(i + 3, t) for i, t in enumerate(texts)] + [(3, texts[0]), (3, texts[0]), (3, "another text of the same id")]
    docs = brute.documents(spark, rows).withColumn("th", F.lit(0)).withColumn("id_", F.lit(1))
    got = ngram_jaccard.keep_one(docs)
    assert got.columns == docs.columns
    per_text = collections.Counter((r["doc_id"], r["text"]) for r in got.collect())
    links = brute.jaccard_links(rows)
    groups = collections.defaultdict(set)
    for k, (i, t) in enumerate(rows):
        groups[links[k][1] if brute.words(t) else ("none", k)].add((i, t))
    text_groups = [g for g in groups.values() if any(brute.words(t) for _, t in g)]
    other = next(g for g in text_groups if (3, "another text of the same id") in g)
    for g in text_groups:
        kept = [x for x in per_text if x in g]
        if g is not other:
            assert len(kept) == 1 and per_text[kept[0]] == 1 and kept[0][0] == min(i for i, _ in g)
    assert sum(n for (i, t), n in per_text.items() if not brute.words(t)) == 3


def test_pruning_rarely_drops_a_pair_at_the_threshold():
    rng = np.random.default_rng(5)
    needs = ngram_jaccard.least_matches(0.8, 1e-6)
    matches = rng.random((200_000, 64)) < 0.8
    lost = np.zeros(len(matches), bool)
    for m, k in needs:
        lost |= matches[:, :m].sum(1) < k
    assert lost.mean() < 1e-4
    far = rng.random((20_000, 64)) < 0.3
    assert (far[:, :16].sum(1) >= needs[0][1]).mean() < 0.65 and (far.sum(1) >= needs[-1][1]).mean() < 1e-3


@pytest.mark.parametrize("many", [False, True])
def test_verification_is_exact(many):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype(np.uint64) for _ in range(25)]
    a, b = np.triu_indices(25, 1)
    if not many:
        a, b = a[:40], b[:40]
    got = ngram_jaccard.verified(a, b, sets, sets, 0.5)
    for x, y, ok in zip(a, b, got):
        s, t = set(sets[x].tolist()), set(sets[y].tolist())
        assert ok == (2 * len(s & t) >= len(s | t))


VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def all_pairs(rows, cosine=0.93):
    """Links and components of (vec_id, embedding, label) rows by comparing all pairs."""
    ok, unit = [], []
    for _, e, label in rows:
        v = np.array([np.nan if x is None else x for x in (e or [])], float)
        good = label is not None and len(v) > 0 and np.isfinite(v).all() and np.abs(v).max() > 0
        ok.append(good)
        unit.append(v / np.linalg.norm(v) if good else None)
    near = collections.defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                near[i].add(j), near[j].add(i)
    return near


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1", "/root/testdata/check_s"])
def test_embeddings_over_the_table(spark, sf):
    if not os.path.exists(f"{sf}/embeddings.parquet"):
        pytest.skip("no such table here")
    rows = table(spark, sf, "embeddings").toPandas()
    x = np.stack(rows.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = pd.Series(0, rows.vec_id)
    for _, at in rows.groupby("label").groups.items():
        c = x[at] @ x[at].T >= 0.93
        np.fill_diagonal(c, False)
        links[rows.vec_id[at]] = c.sum(1)
    got = spherical_caps.op6_spherical_caps(spark, sf).toPandas().set_index("vec_id")
    assert len(got) == len(rows)
    assert (got.n_links <= links[got.index]).all() and got.n_links.sum() >= 0.99 * links.sum()
    assert ((got.component_id == got.index) == got.kept).all() and (got.component_id <= got.index).all()


def test_embeddings_with_odd_rows_and_a_large_group(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.normal(size=64)
    rows = [(i, (base + rng.normal(size=64) * 0.15).tolist(), 1) for i in range(120)]
    rows += [(200 + i, base.tolist(), 1) for i in range(30)] + [(300 + i, (2 * base).tolist(), 2) for i in range(3)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 64, 1), (403, [float("nan")] + [1.0] * 63, 1), (404, [None] + [1.0] * 63, 1),
             (405, [float("inf")] + [1.0] * 63, 1), (406, base.tolist(), None), (None, base.tolist(), 1), (407, [1.0, 2.0], 1), (408, [1.0, 2.1], 1),
             (409, [3.0], 1), (410, [5.0], 1), (0, rows[0][1], 1)]
    rows = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], lab) for i, e, lab in rows]
    near = all_pairs(rows)
    for block in (1024, 16):
        monkeypatch.setattr(spherical_caps, "BLOCK", block)
        df = spherical_caps.near_duplicates(spark.createDataFrame(rows, VEC).withColumn("c", F.lit(1)))
        got = df.collect()
        assert len(got) == len(rows)
        total = sum(r["n_links"] for r in got)
        assert 0.99 * sum(map(len, near.values())) <= total <= sum(map(len, near.values()))
        by = collections.defaultdict(list)
        for r in got:
            by[r["vec_id"]].append(r)
        assert all(by[i][0]["n_links"] == 0 and by[i][0]["component_id"] == i and by[i][0]["kept"] for i in range(400, 407))
        assert {r["component_id"] for r in got if r["vec_id"] is not None and r["vec_id"] < 300} == {0}
        assert by[301][0]["component_id"] == 300 and by[301][0]["n_links"] == 2 and by[410][0]["component_id"] == 409
    assert spherical_caps.near_duplicates(spark.createDataFrame([], VEC)).count() == 0


@pytest.mark.parametrize("parts", [2, 3])
def test_decoding_lists_every_direction(monkeypatch, parts):
    monkeypatch.setattr(spherical_caps, "PARTS", parts)
    monkeypatch.setattr(spherical_caps, "CODES", 24)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(5, 9))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = spherical_caps.codebook(9)
    rotation, cut, words, limit = code
    row, name = spherical_caps.decode(x, code)
    assert len(row)
    want = set()
    for r, v in enumerate(x @ rotation):
        for combination in itertools.product(range(24), repeat=parts):
            if sum(v[p] @ w[:, k] for p, w, k in zip(cut, words, combination)) >= limit:
                want.add((r, sum(k * 24 ** (parts - 1 - n) for n, k in enumerate(combination))))
    assert set(zip(row.tolist(), name.tolist())) == want
