"""The file ledger over landed reports - a killed run goes on where it stopped, files are read once."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from stockroom.sources import ledger
from stockroom.sources.landed import list_files
from stockroom.streaming import days
from stockroom.streaming.history import read_history

HEAD = "code,category,item,quantity,revenue,on_hand,line_no\n"


def _land(folder, day, qty, name="Sales Report {} 100%.csv", rows=2):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name.format(day)), "w") as f:
        f.write(HEAD + "".join(f"c{k},cat,item {k},{qty},1.50,3,{k}\n" for k in range(rows)))


def _history(spark, table):
    return {(r["day"].day, r["code"]): r["units"] for r in read_history(spark, table).collect()}


class Killed(Exception):
    pass


@pytest.mark.parametrize("where", ["before the table", "between table and ledger"])
def test_a_killed_run_goes_on(spark, tmp_path, monkeypatch, where):
    src, book, table = (str(tmp_path / x) for x in ("src", "book", "table"))
    for n in range(1, 8):
        _land(src, f"2024-03-0{n}", n)
    _land(src, "2024-03-03", 99, "~$Sales Report {}.csv")
    real, seen = days.append, []

    def failing(rows, *args, **kwargs):
        seen.append(1)
        if len(seen) == 2:
            if where != "before the table":
                real(rows, *args, **kwargs)
            raise Killed()
        return real(rows, *args, **kwargs)

    listing = list_files(spark, src, "*.csv")
    monkeypatch.setattr(days, "append", failing)
    with pytest.raises(Killed):
        ledger.ingest(spark, listing, book, table, group_files=3)
    assert ledger.done(spark, book).count() == 3
    monkeypatch.setattr(days, "append", real)
    assert ledger.ingest(spark, listing, book, table, group_files=3) == 4
    assert _history(spark, table) == {(n, f"c{k}"): float(n) for n in range(1, 8) for k in range(2)}
    assert ledger.ingest(spark, listing, book, table, group_files=3) == 0
    assert days.read(spark, table).agg(F.sum("lines")).first()[0] == 14


def test_held_days_and_changed_files(spark, tmp_path):
    src, book, table = (str(tmp_path / x) for x in ("src", "book", "table"))
    _land(src, "2024-03-01", 1)
    _land(src, "2024-03-02", 2)
    _land(src, "2024-03-03", 0, rows=0)
    assert ledger.ingest(spark, list_files(spark, src, "*.csv"), book, table) == 3
    assert {r["data_date"].day: r["lines"] for r in ledger.done(spark, book).collect()} == {1: 2, 2: 2, 3: 0}
    _land(src, "2024-03-02", 50, rows=3)  # a held day's file grows
    _land(src, "2024-03-03", 7)           # the file without lines is filled
    _land(src, "2024-03-04", 4)
    listing = list_files(spark, src, "*.csv")
    left = ledger.unread(listing, ledger.done(spark, book), "newest")
    assert {r["data_date"].day for r in left.collect()} == {2, 3, 4}
    assert ledger.ingest(spark, listing, book, table) == 2
    assert _history(spark, table) == {(d, f"c{k}"): q for d, q in ((1, 1.0), (2, 2.0), (3, 7.0), (4, 4.0)) for k in range(2)}
    assert ledger.ingest(spark, listing, book, table, held="newest") == 1
    newest = {(r["day"].day, r["code"]): r["units"] for r in read_history(spark, table, held="newest").collect()}
    assert newest[(2, "c0")] == 50.0 and (2, "c2") in newest and newest[(1, "c0")] == 1.0


def test_an_empty_folder(spark, tmp_path):
    listing = spark.createDataFrame([], "path string, name string, mtime timestamp, size bigint")
    assert ledger.ingest(spark, listing, str(tmp_path / "b"), str(tmp_path / "t")) == 0
    assert ledger.done(spark, str(tmp_path / "b")).count() == 0
    assert read_history(spark, str(tmp_path / "t")).count() == 0
    assert ledger.unread(listing, ledger.done(spark, str(tmp_path / "b"))).columns[0] == "data_date" and datetime.date
