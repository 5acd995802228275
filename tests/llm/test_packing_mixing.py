"""Packing (exact round trip and plan quality) and mixing (targets, caps, SQL)."""

import collections
import zlib

import brute
import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from stockroom.llm import mixing, packing
from stockroom.llm.shared import table
from stockroom.llm.vocabulary import Encoder

SF = "/root/testdata/sf0.01"


def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path())


def check_gapless(rows, length):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return by


def test_encoder_gives_the_tokenizers_ids():
    tok = tokenizer()
    alphabet = "abcXYZ019 '\"`.,!?\n\t\x0b\x1c\x1f\x7f\x00éÉßÀ×÷İıŒŸΣσςΚа漢字́  \u0085²½ªº😀<|startoftext|>ẞﬁ"
    rng = np.random.default_rng(3)
    texts = ["".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(0, 30))) for _ in range(3000)]
    texts += ["<|endoftext|>", "<|ENDOFTEXT|>x", "it's IT'S 'sabc \"'s we'll", "don't'll", " ", "", "ΑΣ ΑΣΑ", "İstanbul", "x" * 3000]
    for a, b in zip(Encoder(packing.tokenizer_path()).encode([t.encode() for t in texts]), tok.encode_batch(texts, add_special_tokens=False)):
        assert a.tolist() == b.ids


def test_table_round_trip(spark):
    tok = tokenizer()
    rows = packing.op10_packing(spark, SF).collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    assert by_doc.keys() == texts.keys()
    for i, t in texts.items():
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4")
        mine = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(-(-len(ids) // 4096)))
        for r in mine:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == 4096 * r["piece"] and len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    total = sum(r["length"] for r in rows)
    assert len(check_gapless(rows, 4096)) <= -(-total // 4096) + 1


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 60))
    counts = {int(n): int(rng.integers(1, 40)) for n in np.unique(rng.integers(1, size + 1, 20))}
    plan = packing.best_fit(counts, size)
    used = collections.Counter()
    for times, inside in plan:
        assert times > 0 and sum(n * k for n, k in inside) <= size
        for n, k in inside:
            used[n] += times * k
    assert used == counts
    low = -(-sum(n * c for n, c in counts.items()) // size)
    ffd = first_fit_decreasing(counts, size)
    assert low <= sum(t for t, _ in plan) <= 1.08 * ffd + 1


def first_fit_decreasing(counts, size):
    gaps = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            for i, g in enumerate(gaps):
                if g >= n:
                    gaps[i] -= n
                    break
            else:
                gaps.append(size - n)
    return len(gaps)


def test_exact_combinations_fill_sequences():
    assert sum(t for t, _ in packing.best_fit({60: 3, 40: 3}, 100)) == 3
    assert sum(t for t, _ in packing.best_fit({50: 4, 30: 4, 20: 4}, 100)) == 4
    assert sum(t for t, _ in packing.best_fit({40: 2, 30: 2, 20: 2, 10: 2}, 100)) == 2
    assert packing.best_fit({}, 100) == []


def test_odd_rows_are_packed(spark):
    rows = [(i, t) for i, t in enumerate(brute.ODD)] + [(None, "null id"), (1, ""), (3, None), (3, "same id again"), (7, "w " * 9000)]
    got = packing.pack_documents(brute.documents(spark, rows), length=64).collect()
    assert sum(r["piece"] == 0 for r in got) == len(rows)
    check_gapless(got, 64)
    assert packing.pack_documents(brute.documents(spark, [])).count() == 0


def test_equal_rows_take_places_of_their_own(spark):
    """A third of all rows without an id, a third under one id, all of one length: no two share a place, and the
    ranks of a length are spread over the tasks that wrote its pieces."""
    rows = [(None, "one two")] * 200 + [(5, "one two")] * 200 + [(i, "one two") for i in range(200)]
    docs = brute.documents(spark, rows).repartition(6)
    got = packing.pack_documents(docs, length=7).collect()
    assert len(got) == 600 and len({(r["sequence_id"], r["offset"]) for r in got}) == 600
    n = got[0]["length"]
    assert {r["length"] for r in got} == {n}
    check_gapless(got, 7)
    assert len({r["sequence_id"] for r in got}) == -(-600 // (7 // n))
    per = packing.numbered(packing.pieces(docs, length=7)).groupBy("length", "__task").count().collect()
    assert max(r["count"] for r in per) <= 150 and sum(r["count"] for r in per) == 600


def test_mix_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", SF):
        ok, why = compare(mixing.op8_mixing(spark, sf), mixing.ORACLE, duck(sf))
        assert ok, why


def level_by_rounds(sizes, cap=3.0):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        rest = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in capped and target[s] >= cap * sizes[s]}
        if not above:
            return target
        capped |= above
        if len(capped) == len(names):
            return {s: cap * sizes[s] for s in names}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 40}, {"x": 7}, {"a": 1, "b": 1, "c": 1, "d": 10000, "é": 300, "z": 0}, {"a": 0, None: 0}])
def test_targets(spark, sizes):
    rows = [(i, " ".join("w" * n), s) for i, (s, n) in enumerate(sizes.items())]
    got = {r["source"]: r for r in mixing.rates(brute.documents(spark, rows).select("source", mixing.size().alias("size"))).collect()}
    want = level_by_rounds(sizes)
    for s in sizes:
        assert got[s]["target"] == pytest.approx(want[s]) and got[s]["rate"] <= 3


@pytest.mark.parametrize("number", [mixing.NUMBERED, 7])
def test_rows_without_ids_and_repeated_rows_come_near_their_targets(spark, monkeypatch, number):
    monkeypatch.setattr(mixing, "NUMBERED", number)
    monkeypatch.setattr(mixing.repeats, "__defaults__", (number,))
    rows = [(None, f"no id {i}", "a") for i in range(900)] + [(7, f"one id {i % 400}", "b") for i in range(900)]
    rows += [(8, "equal rows", "c")] * 800 + [(None, "equal too", "d")] * 700 + [(i, "apart " * 3, "e") for i in range(500)]
    docs = brute.documents(spark, rows)
    plan = mixing.plan(docs).collect()
    taken, target = collections.Counter(), {}
    for r in plan:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert len(plan) == len(rows) and all(abs(taken[s] - t) <= 0.1 * t for s, t in target.items())
    again = mixing.plan(docs.repartition(5)).collect()
    assert sorted(map(tuple, plan), key=str) == sorted(map(tuple, again), key=str)
    assert mixing.mix(docs).count() == sum(r["copies"] for r in plan)


def test_mix_takes_near_targets_and_repeats_alike(spark):
    rows = [(i, "w " * (1 + i % 50), "s" + str(i % 2 + (i % 7 == 0))) for i in range(6000)] + [(None, None, None), (5, "twice", "s1"), (5, "twice", "s1")]
    docs = brute.documents(spark, rows).withColumn("__rate", F.lit("x")).withColumn("size", F.lit(1))
    plan = mixing.plan(docs).collect()
    assert sorted(map(tuple, plan), key=str) == sorted(map(tuple, mixing.plan(docs.repartition(7)).collect()), key=str)
    taken, target = collections.Counter(), {}
    for r in plan:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.1 * t + 1
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in plan)
    assert mixing.plan(brute.documents(spark, [])).count() == 0 and mixing.mix(brute.documents(spark, [])).count() == 0
