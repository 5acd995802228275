"""Streams (T01-T04) run with availableNow over files that overlap in time must equal the batch
result; a replayed micro-batch changes nothing; a late line counts."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockroom.operators.decisions import decision_state
from stockroom.plans.sales import live_base, live_rollup
from stockroom.plans.streams import history_lines, land
from stockroom.sources.tables import tables
from stockroom.streaming import batches, days
from stockroom.streaming import decisions as SD
from stockroom.streaming import history as SH
from stockroom.streaming import live_sales as SL
from stockroom.streaming.snapshot import newest_copy


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def _live_lines(spark):
    return tables(spark, SF_SMALL).sales_lines.select(*[c.split()[0] for c in SL.SALES_LINE_SCHEMA.split(", ")])


@pytest.mark.parametrize("files_per_trigger", [1, 3, None])
def test_live_sales_stream_equals_batch(spark, scratch, files_per_trigger):
    lines = _live_lines(spark)
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    land(lines, F.unix_micros(F.col("ts").cast("timestamp")), src, slices=2, files=4)
    SL.start(spark, src, out, ck, files_per_trigger=files_per_trigger).awaitTermination()
    expected = _rows(live_rollup(lines))
    assert _rows(SL.live_from_stream(spark, out)) == expected
    assert SL.current_grain(spark, out).agg(F.sum("n")).first()[0] == lines.filter("trim(coalesce(code, '')) <> ''").count()
    # nothing new to read, nothing changes
    SL.start(spark, src, out, ck, files_per_trigger=files_per_trigger).awaitTermination()
    assert _rows(SL.live_from_stream(spark, out)) == expected
    # a line of the first day, long after: it counts, and is reported as late
    late = lines.orderBy("ts").limit(1).withColumn("event_id", F.lit(10**9).cast("bigint"))
    before = {r["day"]: r["late"] for r in SL.late_lines(spark, out).collect()}
    late.write.mode("append").parquet(src)
    SL.start(spark, src, out, ck, files_per_trigger=files_per_trigger).awaitTermination()
    assert _rows(SL.live_from_stream(spark, out)) == _rows(live_rollup(lines.unionByName(late)))
    after = {r["day"]: r["late"] for r in SL.late_lines(spark, out).collect()}
    assert sum(after.values()) == sum(before.values()) + 1
    # one compacted batch says the same
    small = os.path.join(scratch, "small")
    batches.compact(spark, out, small, SL.merge_partials)
    assert _rows(SL.live_from_stream(spark, small)) == _rows(SL.live_from_stream(spark, out))


def test_a_replayed_micro_batch_changes_nothing(spark, scratch):
    lines = _live_lines(spark)
    sink = batches.append_partials(scratch, SL.partials)
    half = lines.filter("event_id % 2 = 0")
    sink(half, 0)
    sink(lines.filter("event_id % 2 = 1"), 1)
    sink(half, 0)
    assert _rows(SL.live_from_stream(spark, scratch)) == _rows(live_rollup(lines))


def _expected_history(lines):
    return _rows(lines.groupBy("day", "code").agg(
        F.min_by("category", "line_no").alias("category"), F.min_by("item", "line_no").alias("item"),
        F.sum("quantity").alias("units"), F.sum("revenue").alias("revenue"), F.sum("on_hand").alias("on_hand"),
        F.count("*").alias("lines")))


@pytest.mark.parametrize("files_per_trigger", [1, 40])
def test_history_of_overlapping_files_equals_batch(spark, scratch, files_per_trigger):
    lines = history_lines(tables(spark, SF_SMALL))
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    land(lines, F.col("line_no"), src, slices=2, files=4)  # every day is in several files of both deliveries
    SH.start(spark, src, out, ck, files_per_trigger=files_per_trigger).awaitTermination()
    assert _rows(SH.read_history(spark, out)) == _expected_history(lines)
    t = tables(spark, SF_SMALL)
    assert _rows(SH.read_history(spark, out).select(*t.history.columns)) == _rows(t.history)


def test_one_report_counts_for_a_day(spark, scratch):
    lines = history_lines(tables(spark, SF_SMALL))
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    lines.repartition(4).write.parquet(src)
    SH.start(spark, src, out, ck, files_per_trigger=2).awaitTermination()
    first = _expected_history(lines)
    fix = (lines.filter((F.col("day") >= F.lit(datetime.date(1998, 3, 1))) & (F.col("day") < F.lit(datetime.date(1998, 4, 1))))
                .withColumn("quantity", F.lit(1.0)).withColumn("report_id", F.lit(7).cast("bigint")))
    assert fix.count() > 0
    fix.repartition(3).write.mode("append").parquet(src)
    SH.start(spark, src, out, ck, files_per_trigger=1).awaitTermination()
    # Days already held are skipped
    assert _rows(SH.read_history(spark, out)) == first
    # or the newest report replaces its days, all its files together
    rest = lines.join(fix.select("day").distinct(), "day", "left_anti").unionByName(fix)
    assert _rows(SH.read_history(spark, out, held="newest")) == _expected_history(rest)


def _first_days(spark, n):
    """The lines of the table's first ``n`` days, and the first day."""
    lines = history_lines(tables(spark, SF_SMALL))
    start = lines.agg(F.min("day")).first()[0]
    return lines.filter(F.col("day") < F.lit(start + datetime.timedelta(days=n))), start


def test_history_kept_by_day(spark, scratch):
    """A read of some days opens their folders only; a compaction under the stream and a crash before the manifest change
    nothing."""
    lines, start = _first_days(spark, 150)
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    land(lines, F.col("line_no"), src, slices=2, files=2)
    SH.start(spark, src, out, ck, files_per_trigger=2, unit="day").awaitTermination()
    expected = _expected_history(lines)
    assert _rows(SH.read_history(spark, out)) == expected
    first, last = start + datetime.timedelta(days=20), start + datetime.timedelta(days=109)
    inside = lines.filter(F.col("day").between(F.lit(first), F.lit(last)))
    part = days.read(spark, out, first, last)
    n = inside.select("day").distinct().count()
    assert 30 <= n <= 90 and {f.split("__day=")[1][:10] for f in part.inputFiles()} == {r[0].isoformat() for r in inside.select("day").distinct().collect()}
    assert _rows(SH.read_history(spark, out, first=first, last=last, unit="day")) == _expected_history(inside)
    # the replay of a micro-batch takes its own place
    before = days.manifest(spark, out)
    SH.append_days(out, "day")(spark.read.parquet(src).limit(0), 99)
    assert days.manifest(spark, out) == before
    # a crash after the files, before the manifest
    days._write(days.read(spark, out), out, "day")
    assert _rows(SH.read_history(spark, out)) == expected
    # compaction in place, while the stream goes on
    assert max(map(len, days.manifest(spark, out)[1].values())) == 2
    assert SH.compact(spark, out, unit="day") and max(map(len, days.manifest(spark, out)[1].values())) == 1
    assert _rows(SH.read_history(spark, out)) == expected
    more = lines.limit(40).withColumn("line_no", F.col("line_no") + 10**9)
    more.write.mode("append").parquet(src)
    more = spark.read.parquet(src).filter("line_no > 1000000000")
    SH.start(spark, src, out, ck, files_per_trigger=1, unit="day").awaitTermination()
    assert _rows(SH.read_history(spark, out)) == _expected_history(lines.unionByName(more.select(lines.columns)))
    now = _rows(SH.read_history(spark, out))
    assert days.sweep(spark, out, keep=1) > 0 and len(days.versions(spark, out)) == 1
    assert _rows(SH.read_history(spark, out)) == now


def test_a_replayed_history_batch_after_a_compaction_counts_once(spark, scratch):
    lines, start = _first_days(spark, 90)
    sink, even, odd = SH.append_days(scratch), lines.filter("line_no % 2 = 0"), lines.filter("line_no % 2 = 1")
    sink(even, 0)
    sink(odd, 1)
    sink(odd, 1)
    some = start + datetime.timedelta(days=50)
    assert _rows(SH.read_history(spark, scratch, first=some)) == _expected_history(lines.filter(F.col("day") >= F.lit(some)))
    assert _rows(SH.read_history(spark, scratch)) == _expected_history(lines)


def test_two_writers_of_one_day_table(spark, scratch):
    """The slower of two writers starts over from the faster one's version; none loses rows."""
    rows = spark.createDataFrame([(datetime.date(2024, 1, d), d) for d in (1, 2, 3)], "day date, v int")
    days.replace(rows, scratch, "day")

    def make(held):
        if len(tries) == 0:
            days.replace(rows.filter("v = 2").withColumn("v", F.lit(20)), scratch, "day")
        tries.append(1)
        return held | {"2024-01-09": held["2024-01-03"]}

    tries = []
    days.change(spark, scratch, make)
    assert len(tries) == 2 and sorted(r["v"] for r in days.read(spark, scratch).collect()) == [1, 3, 3, 20]
    assert days.read(spark, scratch, datetime.date(2025, 1, 1)) is None and days.read(spark, scratch + "/none") is None
    assert sorted(r["v"] for r in days.read(spark, scratch, version=1).collect()) == [1, 2, 3]


@pytest.mark.parametrize("order", ["ts", "shuffled", "backwards"])
def test_closed_days_and_late_lines_equal_batch(spark, scratch, order):
    lines = _live_lines(spark)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    src, out, late, ck, done = (os.path.join(scratch, x) for x in ("src", "out", "late", "ck", "done"))
    land(lines, {"ts": us, "shuffled": F.xxhash64("event_id"), "backwards": -us}[order], src)
    SL.start_days(spark, src, out, late, ck, files_per_trigger=2).awaitTermination()
    came = SL.read_late(spark, late)
    assert (came is not None and came.count() > 0) == (order != "ts")
    SL.add_late(spark, out, late, done)
    got = SL.closed_grain(spark, out)
    last = lines.agg(F.max("ts")).first()[0] - datetime.timedelta(days=3)
    assert got.agg(F.max("day")).first()[0] >= last.date()
    closed = got.agg(F.max("day")).first()[0]
    want = live_base(lines).filter(F.col("day") <= F.lit(closed))
    assert _rows(got) == _rows(want)
    # the nightly run again, whole or broken off before it was noted: no line counts twice
    assert SL.add_late(spark, out, late, done) == []
    SL.add_late(spark, out, late, done + "-lost")
    assert _rows(SL.closed_grain(spark, out)) == _rows(want)
    # a late line after a restart is added by the next nightly run; only open days are still held as state
    one = lines.orderBy("ts").limit(1).withColumn("event_id", F.lit(10**9).cast("bigint"))
    one.write.mode("append").parquet(src)
    SL.start_days(spark, src, out, late, ck, files_per_trigger=2).awaitTermination()
    assert len(SL.add_late(spark, out, late, done)) == 1
    assert _rows(SL.closed_grain(spark, out)) == _rows(live_base(lines.unionByName(one)).filter(F.col("day") <= F.lit(closed)))
    held = spark.read.format("statestore").option("path", ck).load().select(F.to_date("key.window.start").alias("day")).distinct().collect()
    assert held and all(r["day"] > closed for r in held)


def _log(spark):
    return tables(spark, SF_SMALL).change_log.select(*[c.split()[0] for c in SD.LOG_SCHEMA.split(", ")])


def test_decision_state_after_each_micro_batch(spark, scratch):
    """State = W07 on the log so far, through restarts, with undos that come before their targets and entries that come
    twice; a batch whose entries are all known changes nothing."""
    log = _log(spark)
    src, feed, ck = (os.path.join(scratch, x) for x in ("src", "feed", "ck"))
    shuffled = log.withColumn("k", F.pmod(F.xxhash64("id"), F.lit(3)))
    so_far = None
    for k in range(3):
        part = shuffled.filter(F.col("k") == k).drop("k")
        part.coalesce(1).write.mode("append").parquet(src)
        SD.start(spark, src, feed, ck).awaitTermination()
        so_far = part if so_far is None else so_far.unionByName(part)
        assert _rows(SD.read_state(spark, ck)) == _rows(decision_state(so_far))
    before = SD.read_feed(spark, feed).filter("kind = 'state'").count()
    part.coalesce(1).write.mode("append").parquet(src)
    SD.start(spark, src, feed, ck).awaitTermination()
    assert _rows(SD.read_state(spark, ck)) == _rows(decision_state(log))
    assert SD.read_feed(spark, feed).filter("kind = 'state'").count() == before
    undos = log.filter("action = 'undo' AND target_id IS NOT NULL")
    sets = log.filter("action <> 'undo'").select(F.col("id").alias("target_id"))
    met = undos.join(sets, "target_id")
    assert SD.read_feed(spark, feed).filter("kind = 'refused'").select("id").distinct().count() == met.count() - met.select("target_id").distinct().count()


def _entry(i, item, action="qty", qty=None, target=None, expected=None, prev=None):
    return (i, datetime.datetime(2024, 1, 1), "Wine", item, action, qty, None, target, *(prev or (None, None, None)), expected)


def test_decision_rules_by_hand(spark, scratch):
    src, feed, ck = (os.path.join(scratch, x) for x in ("src", "feed", "ck"))

    def deliver(*rows):
        spark.createDataFrame(list(rows), SD.INPUT_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        SD.start(spark, src, feed, ck).awaitTermination()
        return {r["item"].strip().lower(): (r["action"], r["qty"], r["set_by"]) for r in SD.read_state(spark, ck).collect()}

    assert deliver(_entry(1, "Ale", qty=5), _entry(2, " ale ", qty=7, prev=("qty", 5, None))) == {"ale": ("qty", 7, 2)}
    assert deliver(_entry(3, "x", "undo", target=2)) == {"ale": ("qty", 5, 3)}
    assert deliver(_entry(4, "x", "undo", target=2)) == {"ale": ("qty", 5, 3)}  # a second undo is refused
    assert deliver(_entry(5, "x", "undo", target=1)) == {}  # nothing was there before entry 1
    assert deliver(_entry(9, "x", "undo", target=6)) == {}  # its target is still to come
    assert deliver(_entry(6, "Rum", "skip", prev=("fix", None, None))) == {"rum": ("fix", None, 9)}
    assert deliver(_entry(8, "x", "undo", target=6), _entry(7, "Rum", "approve")) == {"rum": ("fix", None, 8)}  # an earlier undo, late
    assert deliver(_entry(10, "Rum", "skip", expected=7)) == {"rum": ("fix", None, 8)}  # its writer had not seen 8
    assert deliver(_entry(11, "Rum", "skip", expected=8), _entry(12, "Gin", qty=1, expected=-1)) == {"rum": ("skip", None, 11), "gin": ("qty", 1, 12)}
    kinds = {(r["kind"], r["id"]) for r in SD.read_feed(spark, feed).collect() if r["kind"] != "state"}
    assert kinds == {("refused", 4), ("refused", 9), ("conflict", 10), ("accepted", 11), ("accepted", 12)}


def test_submit_retries_on_conflict(spark, scratch):
    src, feed, ck = (os.path.join(scratch, x) for x in ("src", "feed", "ck"))
    spark.createDataFrame([_entry(1, "Ale", qty=1)], SD.INPUT_SCHEMA).write.mode("append").parquet(src)
    SD.start(spark, src, feed, ck).awaitTermination()
    other = iter([[_entry(2, "Ale", qty=2)], []])

    def advance():  # another writer lands an entry before ours is read, once
        rows = next(other)
        if rows:
            spark.createDataFrame(rows, SD.INPUT_SCHEMA).write.mode("append").parquet(src)
        SD.start(spark, src, feed, ck).awaitTermination()

    mine = spark.createDataFrame([_entry(3, "Ale", qty=3)[:-1]], SD.LOG_SCHEMA)
    os.makedirs(src, exist_ok=True)
    assert SD.submit(spark, mine, src, ck, advance, feed) == 2
    assert [(r["qty"], r["set_by"]) for r in SD.read_state(spark, ck).collect()] == [(3, 3)]


def test_newest_copy_serves_one_whole_copy(spark):
    df = spark.createDataFrame(
        [("cache", datetime.date(2024, 1, 2), "a", 1), ("cache", datetime.date(2024, 1, 2), "b", 2),
         ("file", datetime.date(2024, 1, 3), "a", 5)], "copy string, as_of date, k string, v int")
    out = newest_copy(df)
    assert [(r.copy, r.k) for r in out.collect()] == [("file", "a")]
    assert newest_copy(df.filter("copy = 'cache'")).count() == 2
