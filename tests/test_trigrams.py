"""Substring search through the text index equals the scan, and reads what the needle needs."""

import random

import pytest
from pyspark.sql import functions as F

from stockroom.operators import trigrams

WORDS = ["green", "gear", "Blue", "ale", "12pk", "été", "ale ale", "%_x", ""]
COLS = ["a", "b"]


@pytest.fixture(scope="module")
def tab(spark):
    rng = random.Random(3)
    pick = lambda: rng.choice([None, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4)))])
    rows = [(i, pick(), pick(), "clash") for i in range(600)] + [(600, "x" * 5000 + "needle", "", "row"), (601, "", None, "n")]
    return spark.createDataFrame(rows, "row_id bigint, a string, b string, gram string")


@pytest.fixture(scope="module")
def index(tab):
    return trigrams.build(tab, COLS, "row_id")


@pytest.mark.parametrize("needle", ["", "  ", "e", "al", "ale", "ALE ", "gear blue", "12pk", "été", "needle", "xxxx", "no such", "%_x", "e g", "ale ale ale"])
def test_index_equals_scan(tab, index, needle):
    rows = lambda df: sorted(r["row_id"] for r in df.collect())
    assert rows(trigrams.search(tab, COLS, needle, index)) == rows(trigrams.search(tab, COLS, needle))


def test_short_and_common_needles_are_scanned(spark, tab, index):
    assert trigrams.candidates(index, spark, "al") is None
    assert trigrams.candidates(index, spark, "ale") is None  # in more than a fifth of the rows
    assert trigrams.candidates(index, spark, "needle").count() == 1
    other = trigrams.search(tab, ["a"], "needle", index)  # another list of columns: no index
    assert other.count() == 1 and "Semi" not in other._jdf.queryExecution().optimizedPlan().toString()


def test_postings_are_pruned(spark, index):
    plan = trigrams.candidates(index, spark, "needle")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(gram" in plan


def test_work_follows_the_matches(spark):
    """Ten times the rows with as many matches: the postings read stay, though the table grows."""
    read = []
    for n in (500, 5000):
        tab = spark.range(n).select(F.col("id").alias("row_id"), F.when(F.col("id") < 20, F.lit("rare thing")).otherwise(F.lit("plain stock")).alias("a"))
        index = trigrams.build(tab, ["a"], "row_id")
        best = trigrams.rarest(index, spark, "rare th")
        read.append(sum(k for k, _ in best))
        assert trigrams.search(tab, ["a"], "rare th", index).count() == 20
    assert read[0] == read[1]


def test_an_empty_tab(spark, tab):
    none = tab.limit(0)
    index = trigrams.build(none, COLS, "row_id")
    assert trigrams.search(none, COLS, "ale", index).count() == 0


def test_postings_are_lists_of_blocks(spark, monkeypatch):
    """A gram is written once for a block of rows, not once for a row; blocks lose and repeat nothing."""
    monkeypatch.setattr(trigrams, "BLOCK_ROWS", 64)
    tab = spark.range(0, 1000, 1, 2).select(F.col("id").alias("row_id"), F.concat(F.lit("plain 𝄞é "), F.col("id").cast("string")).alias("a"))
    index = trigrams.build(tab, ["a"], "row_id")
    plain = spark.read.parquet(f"{index.path}/postings").filter("gram = 'n 𝄞'")
    assert plain.count() == 16 and sorted(r[0] for r in plain.select(F.explode("rows")).collect()) == list(range(1000))
    assert trigrams.rarest(index, spark, "𝄞é 77") == [(11, " 77"), (111, "é 7"), (1000, "𝄞é ")]
    assert [r[0] for r in trigrams.search(tab, ["a"], "É 777", index).select("row_id").collect()] == [777]
