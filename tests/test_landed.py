"""Landed-file helpers on small hand-made inputs."""

import datetime
import os
import tempfile

from pyspark.sql import functions as F

from stockroom.sources.landed import (ad_week_items, buyer_master, list_files, newest_report, report_files,
                                      report_items, report_lines, write_sheet)


def test_report_files_one_per_date_folder_priority(spark):
    ts = datetime.datetime(2024, 3, 9, 8, 0)
    listing = spark.createDataFrame([
        ("/a/Inventory 2024-03-07.csv", "Inventory 2024-03-07.csv", ts, 1),
        ("/b/Inventory 2024-03-07.csv", "Inventory 2024-03-07.csv", ts, 0),
        ("/a/Inventory 3.8.24.csv", "Inventory 3.8.24.csv", ts, 1),
        ("/a/~$Inventory 2024-03-09.csv", "~$Inventory 2024-03-09.csv", ts, 0),
        ("/a/export.csv", "export.csv", ts, 1),
        ("/a/Inventory 2024-02-30.csv", "Inventory 2024-02-30.csv", datetime.datetime(2024, 3, 1, 9), 1),
    ], "path string, name string, mtime timestamp, folder int")
    got = {r.data_date: r.path for r in report_files(listing, "folder").collect()}
    assert got == {datetime.date(2024, 3, 7): "/b/Inventory 2024-03-07.csv",
                   datetime.date(2024, 3, 8): "/a/Inventory 3.8.24.csv",
                   datetime.date(2024, 3, 9): "/a/export.csv",
                   datetime.date(2024, 3, 1): "/a/Inventory 2024-02-30.csv"}
    assert newest_report(listing, "folder") == (datetime.date(2024, 3, 9), "/a/export.csv")


def test_list_files_reads_names_not_content(spark):
    d = tempfile.mkdtemp(prefix="landed-")
    for n in ["Sales 2024-01-02.csv", "Sales 2024-01-03.csv"]:
        with open(os.path.join(d, n), "w") as f:
            f.write("x\n")
    names = sorted(r.name for r in list_files(spark, d, "*.csv").collect())
    assert names == ["Sales 2024-01-02.csv", "Sales 2024-01-03.csv"]


def test_reports_end_at_an_empty_page_or_their_total(spark):
    def page(report, n, *items, total=None, bare_list=False):
        body = "[" + ", ".join(items) + "]"
        if not bare_list:
            body = "{" + (f'"estimatedTotal": {total}, ' if total is not None else "") + f'"items": {body}}}'
        return (report, n, body)

    def item(code, wrapped=False):
        leaf = f'{{"productCode": "{code}", "quantity": 2}}'
        return f'{{"item": {leaf}}}' if wrapped else leaf

    pages = spark.createDataFrame([
        page("list", 0, item("a"), item("b", True), bare_list=True), page("list", 1, item("c"), bare_list=True),
        page("empty", 0, item("a")), page("empty", 1), page("empty", 2, item("left over")),
        page("nothing usable", 1, item("a")), page("nothing usable", 2, '{"item": null}', "7", '"x"', "{}"), page("nothing usable", 3, item("left over")),
        page("total", 0, item("a"), total=1000), page("total", 1, item("b")), page("total", 2, item("left over")),
        page("new total", 0, item("a"), total=9999), page("new total", 1, item("b"), total=800), page("new total", 2, item("left over")),
        page("twice", 0, item("a"), item("b")), page("twice", 0, item("a"), item("b")), page("twice", 1, item(" "), item("c")),
        ("broken", 0, "no json"), ("broken", 1, None)], "report string, page int, body string")
    got = {}
    for r in report_lines(pages).orderBy("report", "page", "pos").collect():
        got.setdefault(r["report"], []).append(r["productCode"])
    assert got == {"list": ["a", "b", "c"], "empty": ["a"], "nothing usable": ["a"], "total": ["a", "b"], "new total": ["a", "b"], "twice": ["a", "b", "c"]}
    lone = report_items(pages.filter("report = 'list'"))
    assert [r["productCode"] for r in lone.orderBy("page", "pos").collect()] == ["a", "b", "c"]
    assert report_lines(pages.limit(0)).count() == 0


def test_buyer_master_by_position(spark):
    rows = [(i, *[f"r{i}c{j}" for j in range(30)]) for i in range(5)]
    raw = spark.createDataFrame(rows, "row_idx bigint, " + ", ".join(f"c{j} string" for j in range(30)))
    out = buyer_master(raw)
    assert out.count() == 2
    r = out.orderBy("row_idx").first()
    assert (r.code, r.description, r.retail, r.margin) == ("r3c8", "r3c9", "r3c27", "r3c29")


def test_write_sheet_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="sheet-")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    write_sheet(df, os.path.join(d, "p"))
    write_sheet(df, os.path.join(d, "c"), "csv", gzip=True, single_file=True)
    assert spark.read.parquet(os.path.join(d, "p")).count() == 5
    assert spark.read.option("header", True).csv(os.path.join(d, "c")).count() == 5


def test_ad_week_before_first_block_takes_earliest(spark):
    sheet = spark.createDataFrame([
        (0, "In-Store Ad", "week", None, datetime.date(2024, 5, 6)),
        (1, "", "Type", "Item", None),
        (2, "weekly", "Beer", "Hop  Ale 12pk", None),
        (10, "In-Store Ad", "week", None, datetime.date(2024, 5, 13)),
        (11, "weekly", "Wine", "Red  Blend", None),
    ], "row_idx bigint, c0 string, c1 string, c2 string, c_date date")
    early = ad_week_items(sheet, datetime.date(2024, 1, 1))
    assert [(r.ad_week, r.item) for r in early.collect()] == [(datetime.date(2024, 5, 6), "Hop Ale 12pk")]
    late = ad_week_items(sheet, datetime.date(2024, 5, 20))
    assert [(r.ad_week, r.item) for r in late.collect()] == [(datetime.date(2024, 5, 13), "Red Blend")]
