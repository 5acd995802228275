"""Rows that real files hold and a tidy fixture does not: repeated list keys, missing names, several
codes of one item in a store, ties; and that the fixtures reach every branch the oracle compares."""

import datetime
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockroom.operators.allocate import par_floor, transfer_plan
from stockroom.operators.windows import running_sum
from stockroom.operators.joins import buyer_terms, code_terms, last_rows
from stockroom.operators.quantile import exact_quantile
from stockroom.plans import brief, weekly
from stockroom.plans.base import scoped_inventory, store_needs
from stockroom.sources.landed import ad_week_items, carry_forward_block
from stockroom.sources.tables import tables


def test_lists_repeat_keys_and_the_last_row_wins(spark):
    t = tables(spark, SF_SMALL)
    inv = scoped_inventory(t)
    def with_ads(ads):
        return inv.join(code_terms(inv, ads, t.buy_months, t.deals, t.remove_list, t.new_list), "code_key", "left")

    for lst, keys, join in ((t.par_list, ["code_key", "store"], lambda l: par_floor(inv, l)), (t.ad_list, ["code_key"], with_ads)):
        assert lst.count() > lst.select(*[F.lower(F.trim(c)) for c in keys]).distinct().count()  # the fixture repeats keys
        assert join(lst).count() == inv.count()
        assert join(lst.unionByName(lst.withColumn("list_row", F.col("list_row") - 1))).count() == inv.count()
    terms = buyer_terms(t.deals)
    assert terms.count() == t.deals.select("code_key").distinct().count() < t.deals.count()
    twice = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 7), ("b", 4, 1)], "k string, v int, list_row int")
    assert sorted(map(tuple, last_rows(twice, ["k"]).collect())) == [("a", 2), ("b", 4)]


def test_rows_without_an_item_name_are_no_item(spark):
    needs = store_needs(tables(spark, SF_SMALL))
    lost = needs.limit(40).withColumn("item", F.lit(None).cast("string"))
    items, moves = transfer_plan(needs.unionByName(lost))
    want_items, want_moves = transfer_plan(needs)
    assert items.count() == want_items.count() and moves.count() == want_moves.count()
    assert items.filter("item IS NULL").count() == 0


def test_two_codes_of_an_item_in_a_store_stay_two_rows(spark):
    t = tables(spark, SF_SMALL)
    before = brief.restock_actions(t)

    class Doubled:
        def __getattr__(self, name):
            return getattr(t, name)

        @property
        def inventory(self):
            extra = t.inventory.withColumn("code", F.concat(F.lit("7"), "code")).withColumn("ingest_row", F.col("ingest_row") + 10_000_000)
            return t.inventory.unionByName(extra)

    after = brief.restock_actions(Doubled())
    per = after.groupBy("item", "store").count()
    assert before.count() > 0 and per.agg(F.max("count")).first()[0] == 2
    assert before.count() <= after.count() <= 2 * before.count() + 2  # the other code has a season factor of its own


def test_season_factors_by_item_and_by_category_both_occur(spark):
    from conftest import SF_CHECK
    basis = {r[0] for r in brief.restock_actions(tables(spark, SF_CHECK)).select("season_basis").distinct().collect()}
    assert "item" in basis


def test_every_override_occurs(spark):
    from conftest import SF_CHECK
    t = tables(spark, SF_CHECK)
    orders = weekly.order_lines(weekly.item_plan(store_needs(t)), t).filter("section = 'order'")
    d = t.order_decisions
    hit = orders.join(d, (F.lower(F.trim(orders.dept)) == F.lower(F.trim(d.dept))) & (F.lower(F.trim(orders.item)) == F.lower(F.trim(d.item))))
    seen = {(r["action"], None if r["qty"] is None else r["qty"].lstrip("-").isdigit()) for r in hit.select(d.action, d.qty).collect()}
    assert {("skip", None), ("approve", None), ("fix", None), ("qty", True), ("qty", False)} <= seen


def test_first_of_two_ad_blocks_of_one_date(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(0, "In-Store Ad", "week of", None, day), (1, "", "x", "first", None), (2, "In-Store Ad", "week of", None, day), (3, "", "x", "second", None)]
    sheet = spark.createDataFrame(rows, "row_idx bigint, c0 string, c1 string, c2 string, c_date date")
    assert [r["item"] for r in ad_week_items(sheet, day).collect()] == ["first"]


def test_block_headers_carry_over_ranges_without_one(spark):
    sheet = spark.range(200).select(F.col("id").alias("row_idx"))
    blocks = spark.createDataFrame([(3, datetime.date(2024, 1, 1)), (90, datetime.date(2024, 1, 8))], "row_idx bigint, ad_date date")
    got = {r["row_idx"]: r["block_row"] for r in carry_forward_block(sheet, blocks, ranges=9).collect()}
    assert got == {i: None if i < 3 else 3 if i < 90 else 90 for i in range(200)}


def test_exact_quantile_on_both_sides_of_the_sketch(spark):
    rng = random.Random(1)
    data = {"big": [rng.choice([rng.random(), rng.randrange(20)]) for _ in range(3000)], "small": [3.0, 1.0, 2.0], "one": [5.0]}
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v], "k string, x double")
    for accuracy in (20, 50_000):  # groups above 4 x accuracy use the bracket
        got = {r["k"]: r["q"] for r in exact_quantile(df, "x", 0.7, ["k"], accuracy=accuracy).collect()}
        for k, v in data.items():
            assert abs(got[k] - float(np.quantile(v, 0.7))) < 1e-9


def test_code_terms_is_one_row_a_code(spark):
    """Every list in one row: last row of a code, first positive price, no months as NULL, codes on one list only."""
    inv = spark.createDataFrame([("a", 1, 0.0), ("a", 3, 4.0), ("a", 2, 5.0), ("n", 1, None), (None, 1, 9.0)], "code_key string, ingest_row long, price double")
    ads = spark.createDataFrame([("a", 2, "Sunday", 6.0), ("a", 1, "Weekly", 3.0), ("b", 1, None, None)], "code_key string, list_row int, kind string, target_wos double")
    months = spark.createDataFrame([("a", 11), ("a", 2), ("a", 2)], "code_key string, m int")
    deals = spark.createDataFrame([("a", 1, 60.0, 12.0, 4.0, 8.0), ("d", 1, 0.0, 6.0, 1.0, 0.0)],
                                  "code_key string, list_row int, case_cost double, units_case double, net_unit double, retail double")
    gone, new = (spark.createDataFrame([(c,) for c in codes], "code_key string") for codes in (["b", "b", None], ["a"]))
    rows = {r["code_key"]: r for r in code_terms(inv, ads, months, deals, gone, new).collect()}
    assert set(rows) == {"a", "b", "d"}
    a = rows["a"]
    assert (a["retail"], a["ad_kind"], a["ad_target"], a["buy_months"], a["on_remove"], a["is_new"]) == (5.0, "Sunday", 6.0, [2, 11], False, True)
    assert (a["discount_pct"], a["buyer_gm_pct"], a["deal"]) == (20.0, 50.0, "case of 12.0")
    assert rows["b"]["on_remove"] and rows["b"]["ad_kind"] is None and rows["b"]["buy_months"] is None and not rows["b"]["is_new"]
    assert rows["d"]["retail"] is None and rows["d"]["discount_pct"] is None
    empty = code_terms(inv.limit(0), ads.limit(0), months.limit(0), deals.limit(0), gone.limit(0), new.limit(0))
    assert empty.count() == 0


def test_running_sum_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("x", 1, 5)], "k string, o int, v int")
    got = sorted(map(tuple, running_sum(rows, ["k"], ["o"], "v", "s").select("o", "v", "s").collect()))
    assert got == [(1, 2, 2), (1, 5, 5), (2, 3, 5)]
