"""The fuzzy match looks up pairs in proportion to the data, and loses none it could win."""

import pytest
from pyspark.sql import functions as F

from stockroom.functions.codes import norm_text
from stockroom.operators import matching as M
from stockroom.session import write_table
from stockroom.sources.tables import tables


def _pairs(spark, sf):
    t = tables(spark, sf)
    names = write_table(t.catalog.select(norm_text("item").alias("nd"), "cat_row").groupBy("nd").agg(F.min("cat_row").alias("cid")), "names")
    lines = t.ad_lines.select("line_id", norm_text(F.element_at(F.split("raw", "/"), 1)).alias("nd"))
    q, c = M.tokens(lines, ["line_id"], "nd"), M.tokens(names, ["cid"], "nd")
    vocabulary = write_table(M._vocabulary(q, c), "vocabulary")
    queries = M.split_queries(q, vocabulary, ["line_id"])
    none = spark.createDataFrame([], "cid long, common array<string>")
    return lines.count() * names.count(), M.candidate_pairs(queries, none, vocabulary, c, ["line_id"], "cid").count()


def test_candidate_pairs_grow_with_the_data(spark):
    (all_small, small), (all_large, large) = (_pairs(spark, f"/root/testdata/{sf}") for sf in ("sf0.01", "sf0.1"))
    assert all_large > 50 * all_small  # the input of all pairs grows with the square
    assert large <= 25 * small


NAMES = ["blue gear 5mg", "blue gear 10mg", "red gear", "blueberry gear extra", "5mg", "gear gear gear", "anvil", "bl ge", "xx yy zz", ""]
ASKED = ["blue gear", "blu gea 5mg", "gear", "anvil anvil", "xx nothing here", "nothing at all", "bl ge", "5mg red", "yy red anvil"]


@pytest.mark.parametrize("least_score", [0.6, None])
@pytest.mark.parametrize("reach", [0, 2, 200])
@pytest.mark.parametrize("most", [0, 1, 10])
def test_best_match_is_the_best_of_all_pairs(spark, monkeypatch, least_score, reach, most):
    monkeypatch.setattr(M, "RARE_REACH", reach)
    monkeypatch.setattr(M, "SUBSET_TOKENS", most)
    c = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "cid long, nd string")
    q = spark.createDataFrame([(i, n) for i, n in enumerate(ASKED)], "qid long, nd string")
    rank = c.select("cid", (100 - F.col("cid")).alias("ord"))
    got = {r["qid"]: (r["cid"], r["score"]) for r in M.best_match(
        M.tokens(q, ["qid"], "nd"), M.tokens(c, ["cid"], "nd"), ["qid"], "cid", rank, min_score=least_score).collect()}
    want = {}
    for i, asked in enumerate(ASKED):
        toks = set(asked.split())
        scores = []
        for j, name in enumerate(NAMES):
            words = set(name.split())
            hits = sum(any(w == t or (len(t) >= 3 and w.startswith(t)) for w in words) for t in toks)
            if hits and hits / len(toks) >= (least_score or 0):
                scores.append((-hits, 100 - j, j))
        if scores:
            best = min(scores)
            want[i] = (best[2], -best[0] / len(toks))
    assert got == want
