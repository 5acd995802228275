"""U03 + S07: a folder of daily report files read into the history, each file once, in groups that are committed by themselves.

The ledger is two small folders: ``plan/group=<n>`` names the files of a group before it is read, ``done/group=<n>`` holds the
same rows, with the lines each gave, after its rows are in the table. A group's rows go into the history in one change
that carries the group's tag (``streaming.days``): a group that was planned but not done is read again under the same
tag and takes its own former place. So a run that is killed anywhere and started again reads the rest and nothing twice. One
runner at a time.

``held="first"``: a date that is already held is skipped, whatever its file. ``held="newest"``: a date is read again when its
file is another one (path, size or time). A file without a usable line holds no date; it is read again once it changes.
The driver holds one group's file names at a time.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_parquet_or_none, write_table
from ..streaming import days
from ..streaming.history import daily_partials
from .landed import report_files

GROUP_FILES = 40
REPORT_SCHEMA = ("code string, category string, item string, quantity double, revenue decimal(18,2), on_hand double, line_no bigint")
LEDGER_SCHEMA = "data_date date, path string, name string, mtime timestamp, size bigint, lines bigint, group int"


def same_path(c) -> F.Column:
    """A local path is written ``file:/x`` or ``file:///x``; both become the first."""
    return F.regexp_replace(c, "^file:/+", "file:/")


def read_reports(spark: SparkSession, paths: list[str], schema: str = REPORT_SCHEMA) -> DataFrame:
    """Lines of CSV reports with the ``path`` each came from; files that went away meanwhile give none."""
    lines = spark.read.option("header", True).option("ignoreMissingFiles", True).schema(schema).csv(paths)
    # a file's path is decoded once, not for each of its lines
    files = spark.read.format("binaryFile").option("ignoreMissingFiles", True).load(paths).select(F.col("_metadata.file_path").alias("__file")).distinct()
    files = files.select("__file", same_path(F.url_decode(F.replace(F.col("__file"), F.lit("+"), F.lit("%2B")))).alias("path"))
    return lines.select("*", F.col("_metadata.file_path").alias("__file")).join(F.broadcast(files), "__file").drop("__file")


def done(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """The files read so far."""
    t = read_parquet_or_none(spark, os.path.join(ledger_dir, "done"))
    return spark.createDataFrame([], LEDGER_SCHEMA) if t is None else t.select(*[c.split()[0] for c in LEDGER_SCHEMA.split(", ")])


def unread(listing: DataFrame, read_before: DataFrame, held: str = "first", folder_rank: str | None = None) -> DataFrame:
    """Of a folder listing (path, name, mtime, size) one report per data date (S07) that is still to be read."""
    chosen = report_files(listing, folder_rank).join(listing.select("path", "size"), "path").select("data_date", "path", "name", "mtime", "size")
    left = chosen.join(read_before.select("path", "size", "mtime"), ["path", "size", "mtime"], "left_anti")
    if held == "first":
        left = left.join(read_before.filter("lines > 0").select("data_date"), "data_date", "left_anti")
    return left


def _groups(spark: SparkSession, ledger_dir: str, kind: str) -> list[int]:
    """Numbers of the groups of a ledger folder that were written whole."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{ledger_dir}/{kind}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.getName().removeprefix("group=")) for n in names
                  if n.getName().startswith("group=") and fs.exists(jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS")))


def _read_group(spark: SparkSession, group: int, ledger_dir: str, table_dir: str, read: Callable, unit: str) -> int:
    """Read a planned group into the table and note it as done; returns its number of files."""
    plan = spark.read.parquet(f"{ledger_dir}/plan/group={group}")
    files = plan.select("path", "data_date").collect()  # at most one group's files
    lines = read(spark, [r["path"] for r in files]).join(F.broadcast(plan.select(same_path("path").alias("path"), F.col("data_date").alias("day"))), "path")
    lines = lines.filter(F.trim(F.coalesce(F.col("code"), F.lit(""))) != "").withColumn("report_id", F.lit(group).cast("bigint"))
    days.append(daily_partials(lines), table_dir, "day", f"group-{group}", unit)
    at = [r["data_date"] for r in files]
    table = days.read(spark, table_dir, only=sorted({d.replace(day=1) for d in at} if unit == "month" else set(at)))
    got = None if table is None else table.filter(F.col("report_id") == group).groupBy(F.col("day").alias("data_date")).agg(F.sum("lines").alias("lines"))
    noted = plan.withColumn("lines", F.lit(0).cast("bigint")) if got is None else plan.join(got, "data_date", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))
    noted.coalesce(1).write.mode("overwrite").parquet(f"{ledger_dir}/done/group={group}")
    return len(files)


def ingest(spark: SparkSession, listing: DataFrame, ledger_dir: str, table_dir: str, *, read: Callable = read_reports, group_files: int = GROUP_FILES,
           held: str = "first", folder_rank: str | None = None, unit: str = "month", groups: int | None = None) -> int:
    """Read what the folder holds and the ledger does not, oldest date first, ``group_files`` files at a time; returns the files
    read. ``groups`` stops after that many groups (a run that is to end early); the next run goes on from there."""
    count, ran = 0, 0
    for g in sorted(set(_groups(spark, ledger_dir, "plan")) - set(_groups(spark, ledger_dir, "done"))):
        if groups is not None and ran >= groups:
            return count
        count, ran = count + _read_group(spark, g, ledger_dir, table_dir, read, unit), ran + 1
    todo = write_table(unread(listing, done(spark, ledger_dir), held, folder_rank), "ledger-todo")
    last = None
    while groups is None or ran < groups:
        rest = todo if last is None else todo.filter(F.col("data_date") > F.lit(last))
        chosen = rest.orderBy("data_date").limit(group_files)
        g = max(_groups(spark, ledger_dir, "plan"), default=-1) + 1
        last = chosen.agg(F.max("data_date")).first()[0]
        if last is None:
            break
        chosen.coalesce(1).write.mode("overwrite").parquet(f"{ledger_dir}/plan/group={g}")
        count, ran = count + _read_group(spark, g, ledger_dir, table_dir, read, unit), ran + 1
    return count
