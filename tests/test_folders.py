"""Folders of workbooks, the as-of join and the rollup's grouping sets, on small hand-made inputs and against plain loops."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stockroom.operators.asof import asof_join
from stockroom.plans import sales
from stockroom.plans.base import ctx
from stockroom.plans.books import ad_weeks
from stockroom.sources.folders import (choose_columns, column_profile, elect_headers, folder_tab_items, inventory_rows, inventory_sheets,
                                       price_reference, price_sheets)
from stockroom.sources.landed import ad_week_items
from conftest import SF_SMALL

PAD = ["p"] * 9


def _rows(spark, books):
    """{file: [(sheet, [row, ...]), ...]} as the reader's table."""
    data = [(f, s, k, i, r) for f, sheets in books.items() for k, (s, rows) in enumerate(sheets) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "file string, sheet string, sheet_no int, row_idx bigint, cells array<string>")


def test_price_sheets_of_differing_layout(spark):
    rows = _rows(spark, {
        "/x/Wine 3.xlsx": [("Summary", [["Product UPC", "Net/Unit", *PAD, "x"], ["9", "1"]]),
                           ("wine list", [["title"], ["Product UPC", "Net/Unit", "Buy Months", *PAD, "Product UPC", "Net/Unit"],
                                          ["0012", "", "Jan", *PAD, "77", "5"], ["12.0", "4.5", "ALL"], [None, "3"], []])],
        "/x/Beer 1.xlsx": [("Any", [["Deal Description", "a"], ["", "", *PAD, "late"], ["Units / Case", " PRODUCT UPC", "Net Case Cost", "Deal description", "Product UPC"],
                                    ["6", "0013", "12", " 1 off "], ["0", "14", "12", "nan"], ["x", "12", "9", "beer deal"]])],
        "/x/Late 1.xlsx": [("Late", [["t"]] * 4 + [["Product UPC", "Net/Unit", *PAD, "x"], ["5", "1"]])],
        "/x/Narrow 1.xlsx": [("Narrow", [["Product UPC", "Net/Unit"], ["5", "1"]])],
        "/x/Free 1.xlsx": [("Free", [["Product UPC", "Deal Description", *PAD, "x"], ["5", "d"]])],
        "/x/Empty 1.xlsx": [("Empty", [[]])]})
    got = {r["file"]: (r["sheet"], r["header_row"], dict(r["at"])) for r in price_sheets(rows).collect()}
    assert got == {"/x/Wine 3.xlsx": ("wine list", 1, {"upc": 0, "netunit": 1, "buymonths": 2}),
                   "/x/Beer 1.xlsx": ("Any", 2, {"units": 0, "upc": 1, "casecost": 2, "deal": 3})}
    ref = {r["code_key"]: tuple(r)[1:] for r in price_reference(rows).collect()}
    assert ref == {"12": ("Beer", 4.5, "beer deal", "1"), "13": ("Beer", 2.0, "1 off", None)}
    assert price_reference(rows.limit(0)).count() == 0


def test_inventory_sheet_of_every_workbook(spark):
    need = ["OH", "Product Description"]
    rows = _rows(spark, {
        "a": [("notes", [["a"], ["x"]]), ("plain", [need, ["4", "ale"]]), ("places", [["Location Name", *need], ["S1", " bad ", " ale "], ["S1", "3", None]]),
              ("windows", [["30D", "90D", *need], ["1", "2", "9", "ale"]])],
        "b": [("one", [need, ["1", "rye"]]), ("two", [need, ["2", "rye"]])],
        "c": [("case", [["oh", "product description"], ["1", "gin"]])], "d": [("none", [[None, None]])]})
    assert {r["file"]: r["sheet"] for r in inventory_sheets(rows).collect()} == {"a": "places", "b": "one"}
    assert {(r["file"], r["item"], r["store"], r["on_hand"], r["u30"]) for r in inventory_rows(rows).collect()} == {
        ("a", "ale", "S1", 0.0, 0.0), ("b", "rye", None, 1.0, 0.0)}


def test_tabs_whose_labels_stand_on_two_rows(spark):
    rows = _rows(spark, {
        "/t/Beer 1": [("Remove", [["x", "The Product UPC", "Product UPC"], ["7", "8", "9"], ["Product Description", "n"], ["ale", "001"], ["nan", "2"], ["", "3"], ["rye", "1"]])],
        "/t/Wine 1": [("Remove", [["Product UPC", "Product Description"], ["1", "later"], ["4", "red"]]), ("Other", [["Product UPC", "Product Description"], ["6", "x"]])],
        "/t/Zin 1": [("Remove", [["Product UPC"], ["5"]])]})
    assert {tuple(r) for r in folder_tab_items(rows, "Remove").collect()} == {("1", "ale", "Beer"), ("4", "red", "Wine")}


def test_one_profile_chooses_as_the_single_sheet_does(spark):
    from stockroom.sources.sheets import detect_columns, detect_money_column
    rng, books = random.Random(5), {}
    words = ["Cases", "Line Total", "Ref", "Name", "Ext Cost", "Units sold", "note"]
    for k in range(6):
        head = rng.sample(words, 4)
        kind = [rng.choice(["code", "money", "text", "int"]) for _ in head]
        make = {"code": lambda: f"00{rng.randrange(10**9, 10**10)}", "money": lambda: f"${rng.randrange(1, 900)}.25", "text": lambda: "abc", "int": lambda: str(rng.randrange(-1, 9))}
        books[f"f{k}"] = [("S", [["Product UPC list"] if False else head] + [[make[x]() if rng.random() < 0.9 else "" for x in kind] for _ in range(12)])]
    rows = _rows(spark, books)
    heads = rows.filter("row_idx = 0").select("file", "sheet", F.col("row_idx").alias("header_row"), F.col("cells").alias("header"))
    got = {r["file"]: r for r in choose_columns(column_profile(rows, heads)).collect()}
    for f, [(_, sheet)] in books.items():
        body = [r for r in sheet[1:] if any(r)]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(body)], "row_idx bigint, c0 string, c1 string, c2 string, c3 string")
        at, guessed = detect_money_column(sheet[0], df)
        assert (got[f]["money_at"], got[f]["guessed"]) == (at, guessed)
        assert got[f]["code_at"] == detect_columns(["z"] * 4, df)["upc"]
    assert elect_headers(rows.limit(0)).count() == 0


@pytest.mark.parametrize("ranges", [1, 7])
def test_asof_equals_a_plain_search(spark, ranges):
    rng = random.Random(ranges)
    keys = ["a"] * 8 + ["b", "c", None]  # one key holds most rows
    left = [(i, rng.choice(keys), rng.choice([None, *range(30)])) for i in range(400)] + [(1000, "a", 5)] * 3 + [(2000, "no blocks", 5)]
    right = [(rng.choice(keys), rng.choice([None, *range(3, 27)]), j) for j in range(40)]
    L = spark.createDataFrame(left, "id int, k string, t int")
    R = spark.createDataFrame(right, "k string, at int, j int")

    def plain(k, t, else_first):
        mine = [(a, j) for kk, a, j in right if kk == k and k is not None and a is not None]
        if t is None or not mine:
            return None, None
        past = [x for x in mine if x[0] <= t]
        return min(past, key=lambda x: (-x[0], x[1])) if past else (min(mine) if else_first else (None, None))

    for else_first in (False, True):
        got = asof_join(L, R, ["k"], "t", "at", tie="j", else_first=else_first, ranges=ranges)
        assert got.columns == ["id", "k", "t", "at", "j"]
        assert sorted(got.collect(), key=str) == sorted([(i, k, t, *plain(k, t, else_first)) for i, k, t in left], key=str)
    assert asof_join(L, R.limit(0), ["k"], "t", "at").filter("j IS NULL").count() == len(left)
    assert asof_join(L.limit(0), R, ["k"], "t", "at").count() == 0


def test_ad_weeks_equal_the_single_date(spark):
    d = datetime.date
    rows = [("s", 0, "In-Store Ad", "w", None, d(2024, 5, 13)), ("s", 10, "In-Store Ad", "w", None, d(2024, 5, 6)), ("s", 20, "in-store ad", "w", None, d(2024, 5, 13)),
            ("s", 30, "Content due", "", None, None), *[("s", 10 * b + 1, "", "Beer", f"item {b}", None) for b in range(4)]]
    sheet = spark.createDataFrame(rows, "sheet string, row_idx bigint, c0 string, c1 string, c2 string, c_date date")
    days = spark.createDataFrame([("s", d(2024, 5, n)) for n in (1, 6, 12, 13, 30)], "sheet string, day date")
    got = {r["day"].day: (r["ad_date"].day, r["block_row"]) for r in ad_weeks(days, sheet, ["sheet"]).collect()}
    assert got == {1: (6, 10), 6: (6, 10), 12: (6, 10), 13: (13, 0), 30: (13, 0)}
    for n, (ad, block) in got.items():
        one = ad_week_items(sheet, d(2024, 5, n)).collect()
        assert {(r["ad_week"].day, r["item"]) for r in one} == {(ad, f"item {block // 10}")}


def test_rollup_levels_are_one_expand(spark):
    base = sales.live_base(ctx(spark, SF_SMALL).sales_lines)
    plan = sales.live_levels(base)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand [") == 1 or plan.count("Expand (") == 1 or plan.count(" Expand") == 1
    assert plan.count("FileScan") == 1 and plan.count("Union") == 0
    assert sales.live_levels(base.limit(0)).count() == 0
