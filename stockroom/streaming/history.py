"""Daily sales history kept current from landed daily report files.

A report is delivered as one or more files; each line names its report (``report_id``, ascending in
time of delivery). Every micro-batch is reduced to (day, report, code) partials - A03 - and readers
sum all partials of one report, so a day may span any number of files and micro-batches.

The table is kept by month, or by day (``days``, ``unit``): a micro-batch adds a folder to the months it holds, in one change
that is seen whole, and a replay takes the place of what it had added. A read of some days opens their folders alone.
``compact`` merges a month's folders in the table that a running stream goes on writing to.

One report counts for each day. U03: a day that is already held is skipped, so the first report of a
day stays (``held="first"``); ``held="newest"`` lets a later report replace its days.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import batches, days

FILES_PER_TRIGGER = 40

LINE_SCHEMA = ("day date, code string, category string, item string, quantity double, revenue decimal(18,2), "
               "on_hand double, line_no bigint, report_id bigint")
HISTORY_COLUMNS = ["day", "code", "category", "item", "units", "revenue", "on_hand", "lines"]
HISTORY_SCHEMA = ("day date, code string, category string, item string, units double, revenue decimal(28,2), "
                  "on_hand double, lines bigint")


def daily_partials(lines: DataFrame) -> DataFrame:
    """Per (day, report, code) - units, revenue, on-hand, line count and the first line's category
    and description (of the lines at hand)."""
    return (lines.groupBy("day", "report_id", "code")
                 .agg(F.min(F.struct("line_no", "category", "item")).alias("first"), F.sum("quantity").alias("units"),
                      F.sum("revenue").alias("revenue"), F.sum("on_hand").alias("on_hand"), F.count("*").alias("lines")))


def merge_partials(partials: DataFrame) -> DataFrame:
    return (partials.groupBy("day", "report_id", "code")
                    .agg(F.min("first").alias("first"), F.sum("units").alias("units"), F.sum("revenue").alias("revenue"),
                         F.sum("on_hand").alias("on_hand"), F.sum("lines").alias("lines")))


def append_days(table_dir: str, unit: str = "month"):
    """A foreachBatch sink that adds the micro-batch's partials to their days."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        days.append(daily_partials(batch), table_dir, "day", f"batch-{batch_id}", unit)
    return sink


def start(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str, *,
          files_per_trigger: int = FILES_PER_TRIGGER, available_now: bool = True, unit: str = "month"):
    return batches.run(spark, LINE_SCHEMA, source_dir, checkpoint_dir, append_days(table_dir, unit),
                       files_per_trigger=files_per_trigger, available_now=available_now, interval="1 hour")


def compact(spark: SparkSession, table_dir: str, least: int = 2, unit: str = "month") -> list[str]:
    """Merge the folders of the months (days) that have ``least`` or more, in place; returns them."""
    return days.compact(spark, table_dir, "day", merge_partials, least, unit)


def read_history(spark: SparkSession, table_dir: str, held: str = "first", first: datetime.date | None = None,
                 last: datetime.date | None = None, unit: str = "month") -> DataFrame:
    """The history, or its days from ``first`` to ``last``: one row per (day, code) of the report that holds the day."""
    t = days.read(spark, table_dir, first.replace(day=1) if first and unit == "month" else first, last)
    if t is None:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    if first:
        t = t.filter(F.col("day") >= F.lit(first))
    if last:
        t = t.filter(F.col("day") <= F.lit(last))
    pick = {"first": F.min, "newest": F.max}[held]
    holder = t.groupBy("day").agg(pick("report_id").alias("report_id"))  # one row per calendar day
    # a folder has one partial of a key, so the partials are dealt out as they are and sorted once, where they are merged
    held = t.join(F.broadcast(holder), ["day", "report_id"]).repartition("day", "report_id", "code")
    return merge_partials(held).select("day", "code", F.col("first.category").alias("category"), F.col("first.item").alias("item"),
                                       "units", "revenue", "on_hand", "lines")
