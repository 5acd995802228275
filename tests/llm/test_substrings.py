"""Repeated passages against a plain version."""

import random

import brute
from stockroom.llm.shared import table
from stockroom.llm.substring_dedup import dedup, op5_substring_dedup

SF = "/root/testdata/sf0.01"


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


def test_table_matches_plain_version(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    df = op5_substring_dedup(spark, SF).withColumnRenamed("kept_sha256", "kept")
    expected = sorted(brute.substring_dedup(rows), key=str)
    assert sum(r[2] for r in expected) > 0 and got(df) == expected


def test_odd_and_periodic_rows(spark):
    rng = random.Random(5)
    passage = " ".join(rng.choice("abcdefgh") for _ in range(60))
    texts = [*brute.ODD, passage, passage + " x", "y " + passage, "a b " * 40, "a b c " * 30, "q " * 19, "q " * 20, "q " * 21,
             " ".join(rng.choice("ab") for _ in range(400)), passage.replace(" ", " ", 1), passage.replace(" ", "\n")]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, passage), (None, "z " + passage), (3, "a b " * 40), (12, passage), (12, "other " + passage)]
    df = dedup(brute.documents(spark, rows).repartition(5), digest=True)
    assert got(df) == sorted(brute.substring_dedup(rows), key=str)


def test_many_partitions_and_a_hot_passage(spark):
    rng = random.Random(6)
    hot = " ".join(str(rng.random()) for _ in range(30))
    rows = [(i, " ".join(str(rng.randrange(9)) for _ in range(rng.randrange(5, 60))) + (" " + hot if i % 3 == 0 else "")) for i in range(600)]
    df = dedup(brute.documents(spark, rows).repartition(13), digest=True)
    assert got(df) == sorted(brute.substring_dedup(rows), key=str)


def test_messages_go_to_single_rows(spark):
    rng = random.Random(8)
    hot = " ".join(str(rng.random()) for _ in range(30))
    rows = [(None if i % 3 else i % 2, f"{hot} {i}" if i % 2 else f"{i} {hot}") for i in range(90)]
    df = dedup(brute.documents(spark, rows).repartition(4), digest=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(row#" in plan and "hashpartitioning(key#" not in plan
    assert got(df) == sorted(brute.substring_dedup(rows), key=str)


def test_ties_in_a_batch_share_the_answer(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # earlier holders stay in other partitions
    rng = random.Random(7)
    text = lambda n: " ".join(str(rng.random()) for _ in range(n))
    hot, other = text(30), text(25)
    ties = [(None, f"{hot} {text(9)}") for _ in range(4)] + [(7, f"{text(3)} {hot} {i} {other}") for i in range(4)] + [(None, f"{hot} 1 {other}")] * 2
    rows = [(1, f"{text(5)} {hot}"), (2, f"{other} {text(4)}")]
    for first, last in ((rows, ties), (ties[:3], ties[3:] + rows), (ties, [])):
        df = brute.documents(spark, first).coalesce(1).unionAll(brute.documents(spark, last).coalesce(1))
        assert got(dedup(df, digest=True)) == sorted(brute.substring_dedup(first + last), key=str)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table_and_kept_text(spark):
    assert dedup(brute.documents(spark, [])).count() == 0
    text = " ".join(str(i) for i in range(25))
    r = sorted(dedup(brute.documents(spark, [(1, text), (2, "a " + text + " b")])).collect(), key=lambda r: r["doc_id"])
    assert bytes(r[0]["kept"]).decode() == text and bytes(r[1]["kept"]).decode() == "a b"
