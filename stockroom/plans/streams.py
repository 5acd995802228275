"""Registered stream runs (T01-T03): land the input table as files in time order, run the
stream once with ``availableNow`` into tables under the shared checkpoint folder, and read
the result back. Each run uses its own folder, so runs never see each other's state."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import tasks_for
from ..session import checkpoint_dir, write_table
from ..streaming import decisions as SD
from ..streaming import history as SH
from ..streaming import live_sales as SL
from .base import ctx

SLICES = 3  # deliveries landed per run
FILES = 4  # files of a delivery, at least; each holds lines of all its days
FILE_ROWS = 2_000_000  # rows of a file, about: large deliveries have more files
LEDGER_GROUP = 200  # report files of a group of the ledger run
LEDGER_SHIFT = 3653  # days: file names carry dates of this century only
FILES_PER_TRIGGER = 3  # so a delivery spans micro-batches, and a micro-batch spans deliveries


def _run_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def land(df: DataFrame, order: F.Column, path: str, slices: int = SLICES, files: int = FILES) -> None:
    """Land ``df`` as ``slices`` deliveries in ``order`` (one write each, so the file source sees
    them oldest first), each of ``files`` files that overlap in time. Slice bounds come from one
    approximate-quantile pass; the streams do not depend on them."""
    keyed = df.withColumn("_o", order.cast("double"))
    cuts = keyed.approxQuantile("_o", [i / slices for i in range(1, slices)], 0.001) if slices > 1 else []
    edges = [None, *cuts, None]
    for k in range(slices):
        part = keyed
        if edges[k] is not None:
            part = part.filter(F.col("_o") > edges[k])
        if edges[k + 1] is not None:
            part = part.filter(F.col("_o") <= edges[k + 1])
        part.drop("_o").repartition(files).write.mode("append").parquet(path)


def deliver(df: DataFrame, order: F.Column, path: str) -> int:
    """``land`` the rows of a table, in more files the more rows there are; returns how many files a micro-batch takes."""
    files = max(FILES, -(-df.count() // (SLICES * FILE_ROWS)))
    land(df, order, path, files=files)
    return files * FILES_PER_TRIGGER // FILES


def _live_run(spark: SparkSession, sf_dir: str) -> str:
    lines = ctx(spark, sf_dir).sales_lines.select(*[c.split()[0] for c in SL.SALES_LINE_SCHEMA.split(", ")])
    d = _run_dir(spark, "live")
    files = deliver(lines, F.unix_micros(F.col("ts").cast("timestamp")), os.path.join(d, "src"))
    SL.start(spark, os.path.join(d, "src"), os.path.join(d, "out"), os.path.join(d, "ck"),
             files_per_trigger=files).awaitTermination()
    return os.path.join(d, "out")


def q_stream_live_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 over the sale lines: the streamed rollup equals the batch ``live_rollup``."""
    return SL.live_from_stream(spark, _live_run(spark, sf_dir))


def q_stream_live_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 reconciliation: lines and units per day in the streamed grain, to compare with the source."""
    grain = SL.current_grain(spark, _live_run(spark, sf_dir))
    return grain.groupBy("day").agg(F.sum("n").alias("lines"), F.sum("u").cast("bigint").alias("units"),
                                    F.sum("s").cast("decimal(28,2)").alias("sales"))


def history_lines(t) -> DataFrame:
    """The shipped lines as one daily report each day (report 0)."""
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
              .select(F.col("l_shipdate").cast("date").alias("day"), (F.lit(900000000000) + F.col("l_partkey")).cast("string").alias("code"),
                      F.col("p_brand").alias("category"), F.col("p_name").alias("item"),
                      F.col("l_quantity").cast("double").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("revenue"),
                      (F.col("l_orderkey") % 50).cast("double").alias("on_hand"),
                      (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("line_no"),
                      F.lit(0).cast("bigint").alias("report_id")))


def q_stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T02 over the shipped lines as daily reports: the streamed history table equals the
    batch daily rollup (the ``history`` view)."""
    d = _run_dir(spark, "history")
    lines = write_table(history_lines(ctx(spark, sf_dir)), "shipped-lines")  # joined once for all deliveries
    files = deliver(lines, F.unix_date("day"), os.path.join(d, "src"))
    SH.start(spark, os.path.join(d, "src"), os.path.join(d, "out"), os.path.join(d, "ck"),
             files_per_trigger=files).awaitTermination()
    return SH.read_history(spark, os.path.join(d, "out"))


def _decision_run(spark: SparkSession, sf_dir: str) -> str:
    log = ctx(spark, sf_dir).change_log.select(*[c.split()[0] for c in SD.LOG_SCHEMA.split(", ")])
    d = _run_dir(spark, "decisions")
    files = deliver(log, F.col("id"), os.path.join(d, "src"))
    SD.start(spark, os.path.join(d, "src"), os.path.join(d, "feed"), os.path.join(d, "ck"), files_per_trigger=files,
             partitions=max(spark.sparkContext.defaultParallelism, tasks_for(log.count()))).awaitTermination()
    return d


def q_stream_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T03 over the change log: the keyed state equals the batch fold."""
    return SD.read_state(spark, os.path.join(_decision_run(spark, sf_dir), "ck"))


def q_stream_decision_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The undos that the stream refused, with the entry each wanted to undo."""
    feed = SD.read_feed(spark, os.path.join(_decision_run(spark, sf_dir), "feed"))
    return feed.filter("kind = 'refused'").select(F.col("id").alias("undo_id"), "target_id", "dept_key", "item_key").distinct()


def q_stream_live_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 in event time: all days that the watermark has closed, with the late lines added by the nightly run. The lines
    are landed out of order, so many of them are late."""
    lines = ctx(spark, sf_dir).sales_lines.select(*[c.split()[0] for c in SL.SALES_LINE_SCHEMA.split(", ")])
    d = _run_dir(spark, "days")
    src, out, late, ck, done = (os.path.join(d, x) for x in ("src", "out", "late", "ck", "done"))
    files = deliver(lines, F.xxhash64("event_id"), src)
    SL.start_days(spark, src, out, late, ck, files_per_trigger=files).awaitTermination()
    SL.add_late(spark, out, late, done)
    return SL.closed_grain(spark, out).select("day", "dept", "store", "code", F.col("u").cast("bigint").alias("units"),
                                              F.col("s").cast("decimal(28,2)").alias("sales"), F.col("first.d").alias("item"), F.col("n").alias("lines"))


def q_ledger_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U03 + S07 over the shipped lines landed as one CSV report a week: a run that ends after its first group and one that reads
    the rest make the whole history by weeks."""
    from ..sources import ledger
    d = _run_dir(spark, "ledger")
    src, book, out = (os.path.join(d, x) for x in ("src", "ledger", "out"))
    lines = history_lines(ctx(spark, sf_dir)).drop("report_id").withColumn("day", F.trunc("day", "week"))
    named = lines.withColumn("report", F.concat(F.lit("Sales "), F.date_format(F.date_add("day", LEDGER_SHIFT), "yyyy-MM-dd"))).drop("day")
    named.repartition("report").write.partitionBy("report").option("header", True).csv(src)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(src).select(
        "path", F.element_at(F.split("path", "/"), -2).alias("name"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    ledger.ingest(spark, files, book, out, group_files=LEDGER_GROUP, groups=1)
    ledger.ingest(spark, files, book, out, group_files=LEDGER_GROUP)
    return SH.read_history(spark, out).withColumn("day", F.date_sub("day", LEDGER_SHIFT))
