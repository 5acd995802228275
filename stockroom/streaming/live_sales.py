"""Live sales rollup kept current from a stream of sale lines.

Sale lines land as files in any order. Each micro-batch is reduced to (store-local day, dept, store,
code) partials by the batch ``live_base`` and readers sum them, so a line counts whenever it
arrives and a day may span any number of files. Every rollup level is then computed from that grain by
the batch ``live_levels``. ``late_lines`` reports what came after its day had been read.

``start_days`` is the same rollup in event time: a tumbling window of one store-local day with a watermark. A day is written
once, when the watermark has passed its end, and its state goes; only open days are held. What comes for a closed day is
dropped by the window and written, line for line, to a late table by the same micro-batch, from what Spark's own log says
about it (its files, and the watermark it dropped by), so no line is in both or in neither. ``add_late`` is the nightly run
that adds late lines to the days they belong to. The window's grain is kept by day, so a day is read or rewritten alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sales import STORE_ZONE, first_sale, live_base, live_levels, live_lines
from . import batches, days

SALES_LINE_SCHEMA = ("event_id bigint, ts timestamp_ntz, store string, department string, code string, "
                     "description string, quantity int, total decimal(18,2)")
GRAIN_SCHEMA = ("day date, dept string, store string, code string, u bigint, s decimal(28,2), "
                "first struct<ts:timestamp_ntz,event_id:bigint,d:string>, n bigint")


def partials(lines: DataFrame, mapping=None) -> DataFrame:
    """A micro-batch's part of the grain, with its number of lines."""
    return live_base(lines, mapping)


def start(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str, *,
          files_per_trigger: int | None = None, available_now: bool = True, mapping=None):
    """Run the stream: parquet files of sale lines in ``source_dir`` -> grain table."""
    return batches.run(spark, SALES_LINE_SCHEMA, source_dir, checkpoint_dir,
                       batches.append_partials(table_dir, lambda b: partials(b, mapping)),
                       files_per_trigger=files_per_trigger, available_now=available_now, interval="15 minutes")


DELAY = "1 day"


def local_lines(lines: DataFrame, mapping=None) -> DataFrame:
    """Sale lines with their store-local time (the session's zone is UTC, so a day window starts at local midnight)."""
    return live_lines(lines, mapping).withColumn("local", F.from_utc_timestamp(F.col("ts").cast("timestamp"), STORE_ZONE))


def start_days(spark: SparkSession, source_dir: str, table_dir: str, late_dir: str, checkpoint_dir: str, *, delay: str = DELAY,
               files_per_trigger: int | None = None, available_now: bool = True, mapping=None):
    """Run the event-time stream: closed days of ``source_dir``'s lines -> ``table_dir``, lines that came too late ->
    ``late_dir``."""
    reader = spark.readStream.schema(SALES_LINE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    grain = (local_lines(reader.parquet(source_dir), mapping).withWatermark("local", delay)
             .groupBy(F.window("local", "1 day").alias("w"), "dept", "store", "code")
             .agg(F.sum("quantity").alias("u"), F.sum("total").alias("s"), first_sale().alias("first"), F.count("*").alias("n"))
             .select(F.to_date("w.start").alias("day"), "dept", "store", "code", "u", "s", "first", "n"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession
        days.replace(batch, table_dir, "day")
        dropped = too_late(here, checkpoint_dir, batch_id, mapping)
        if dropped is not None:
            dropped.write.mode("overwrite").parquet(f"{late_dir}/batch_id={batch_id}")

    w = grain.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")).start()


def log_lines(spark: SparkSession, path: str) -> list[str]:
    """The JSON lines of the small log files that match ``path``."""
    from pyspark.errors import AnalysisException
    try:
        return [r[0] for r in spark.read.text(path).filter("value LIKE '{%'").collect()]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return []
        raise


def too_late(spark: SparkSession, checkpoint_dir: str, batch_id: int, mapping=None) -> DataFrame | None:
    """The lines of a micro-batch whose day had been closed before it: the day's end is not past the watermark of the
    micro-batch before, by which Spark drops. None if it read no files or there was no watermark."""
    import json
    before, now = ([json.loads(x) for x in log_lines(spark, f"{checkpoint_dir}/offsets/{b}")] for b in (batch_id - 1, batch_id))
    mark = max((e["batchWatermarkMs"] for e in before if "batchWatermarkMs" in e), default=0)
    # the file source numbers its own log; a batch read the entries from the one before's offset to its own
    low, high = (max((e["logOffset"] for e in x if "logOffset" in e), default=-1) for x in (before, now))
    names = ",".join(f"{k},{k}.compact" for k in range(low + 1, high + 1))
    files = sorted({e["path"] for e in map(json.loads, log_lines(spark, f"{checkpoint_dir}/sources/0/{{{names}}}")) if low < e["batchId"] <= high}) if names else []
    if not files or mark <= 0:
        return None
    lines = spark.read.schema(SALES_LINE_SCHEMA).parquet(*files)
    ends = F.col("day").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    return local_lines(lines, mapping).filter(ends <= F.timestamp_millis(F.lit(mark))).drop("local")


def read_late(spark: SparkSession, late_dir: str) -> DataFrame | None:
    return batches.read_partials(spark, late_dir)


def add_late(spark: SparkSession, table_dir: str, late_dir: str, done_dir: str) -> list:
    """The nightly run: late lines not added before are added to their days, which are rewritten; returns the days.

    A day that is written again takes all late lines of that day, those of earlier runs too, from the day's own
    streamed rows, so a run that is broken off and repeated counts no line twice. ``done_dir`` holds which micro-batches
    have been added."""
    late = read_late(spark, late_dir)
    if late is None:
        return []
    done = batches.read_partials(spark, done_dir)
    new = late if done is None else late.join(done.select("batch_id").distinct(), "batch_id", "left_anti")
    touched = sorted(r[0] for r in new.select("day").distinct().collect())  # calendar days
    if touched:
        added = (late.filter(F.col("day").isin(touched)).groupBy("day", "dept", "store", "code")
                     .agg(F.sum("quantity").alias("u"), F.sum("total").alias("s"), first_sale().alias("first"), F.count("*").alias("n"))
                     .withColumn("late", F.lit(True)))
        base = days.read(spark, table_dir, only=touched)
        if base is not None:  # a day whose lines all came late has no rows yet
            streamed = base.filter("NOT coalesce(late, false)").drop("late") if "late" in base.columns else base
            added = streamed.withColumn("late", F.lit(False)).unionByName(added)
        rows = added
        days.replace(rows, table_dir, "day")
    new.select("batch_id").distinct().coalesce(1).write.mode("append").parquet(done_dir)
    return touched


def closed_grain(spark: SparkSession, table_dir: str) -> DataFrame:
    """The (day, dept, store, code) groups of all closed days, with the late lines added so far."""
    t = days.read(spark, table_dir)
    return spark.createDataFrame([], GRAIN_SCHEMA) if t is None else merge_partials(t)


def merge_partials(t: DataFrame) -> DataFrame:
    return t.groupBy("day", "dept", "store", "code").agg(
        F.sum("u").alias("u"), F.sum("s").alias("s"), F.min("first").alias("first"), F.sum("n").alias("n"))


def current_grain(spark: SparkSession, table_dir: str) -> DataFrame:
    """Every (day, dept, store, code) group over all micro-batches so far."""
    t = batches.read_partials(spark, table_dir)
    return spark.createDataFrame([], GRAIN_SCHEMA) if t is None else merge_partials(t)


def late_lines(spark: SparkSession, table_dir: str) -> DataFrame:
    """Per day: all lines, and those that came in a later micro-batch than the day's first."""
    t = batches.read_partials(spark, table_dir)
    if t is None:
        return spark.createDataFrame([], "day date, lines bigint, late bigint")
    per = t.groupBy("day", "batch_id").agg(F.sum("n").alias("n"))
    return per.groupBy("day").agg(F.sum("n").alias("lines"), (F.sum("n") - F.min_by("n", "batch_id")).alias("late"))


def live_from_stream(spark: SparkSession, table_dir: str) -> DataFrame:
    """A07 levels over the streamed grain."""
    return live_levels(current_grain(spark, table_dir))
