"""Tables kept by day, replaced day by day, with one small manifest that says which folders count.

Every change writes the new folders of the days it touches under a version of its own (``v=<version>/day=...``) and then
writes one manifest, ``manifest/<version>.json``: day -> version. Readers take the newest manifest and list the folders it
names, so they see a change whole or not at all, a crash before the manifest leaves files nobody reads, and a change that is
run again writes the same days again. A read of some days opens those folders only, and a running stream and a
compaction work on the same table: the second of two writers that race for one version fails on its manifest and starts over
from the newer one.

Days are folders, so their number follows the calendar, not the data; the manifest has a line for each. A table that is only
added to may be kept by month instead (``unit``), which suits long histories of small days: a read opens the months it needs.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RACES = 8


class Raced(RuntimeError):
    """Another writer put up this version first."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """The versions that have a manifest, ascending."""
    jvm, fs, p = _hadoop(spark, f"{table_dir}/manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def manifest(spark: SparkSession, table_dir: str, version: int | None = None) -> tuple[int, dict[str, list[str]]]:
    """(version, day -> folders) of a version, the newest by default; (0, {}) for a table not written yet."""
    have = versions(spark, table_dir)
    if not have:
        return 0, {}
    version = have[-1] if version is None else version
    text = "".join(r[0] for r in spark.read.text(f"{table_dir}/manifest/{version:012d}.json").collect())
    return version, json.loads(text)


def _put(spark: SparkSession, table_dir: str, version: int, held: dict[str, list[str]]) -> None:
    """Write a manifest under its own name first, then give it its version's name; only one writer can."""
    jvm, fs, target = _hadoop(spark, f"{table_dir}/manifest/{version:012d}.json")
    draft = jvm.org.apache.hadoop.fs.Path(f"{table_dir}/manifest/_draft-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(held, sort_keys=True).encode()))
    out.close()
    try:
        if fs.exists(target) or not fs.rename(draft, target):
            raise Raced(f"version {version} of {table_dir} is taken")
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def _write(rows: DataFrame, table_dir: str, day: str, unit: str = "day") -> dict[str, str]:
    """Write ``rows`` as folders of days under a new name; day -> folder."""
    name = f"data/{uuid.uuid4().hex}"
    # a day's rows come together, and a day with too many for one task is split (adaptive rebalancing)
    (rows.withColumn("__day", F.date_format(F.date_trunc(unit, day), "yyyy-MM-dd")).hint("rebalance", "__day").write
         .partitionBy("__day").parquet(f"{table_dir}/{name}"))
    jvm, fs, p = _hadoop(rows.sparkSession, f"{table_dir}/{name}")
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return {n.removeprefix("__day="): f"{name}/{n}" for n in found if n.startswith("__day=") and "__HIVE" not in n}


def change(spark: SparkSession, table_dir: str, make) -> int:
    """Put up the next version: ``make(day -> folders)`` gives the new mapping, again from the newer one if another
    writer was faster. Returns the version."""
    for _ in range(RACES):
        version, held = manifest(spark, table_dir)
        new = make(held)
        if new == held:
            return version
        try:
            _put(spark, table_dir, version + 1, new)
            return version + 1
        except Raced:
            continue
    raise Raced(f"{table_dir}: {RACES} other writers were faster")


def replace(rows: DataFrame, table_dir: str, day: str) -> int:
    """The days of ``rows`` now hold just these rows; other days stay. Rows without a day are left out."""
    written = _write(rows.filter(F.col(day).isNotNull()), table_dir, day)
    return change(rows.sparkSession, table_dir, lambda held: held | {d: [f] for d, f in written.items()})


def append(rows: DataFrame, table_dir: str, day: str, tag: str, unit: str = "day") -> int:
    """Add ``rows`` to their days. ``tag`` names the delivery: one that is delivered again takes its former place."""
    written = _write(rows.filter(F.col(day).isNotNull()), table_dir, day, unit)
    mark = f"#{tag}"

    def make(held):
        out = {d: [f for f in fs if not f.endswith(mark)] for d, fs in held.items()}
        for d, f in written.items():
            out.setdefault(d, []).append(f + mark)
        return {d: fs for d, fs in out.items() if fs}

    return change(rows.sparkSession, table_dir, make)


def read(spark: SparkSession, table_dir: str, first: datetime.date | None = None, last: datetime.date | None = None,
         only: list[datetime.date] | None = None, version: int | None = None) -> DataFrame | None:
    """The table, or its days from ``first`` to ``last``, or ``only`` some: just their folders are opened. None if it has
    no such day."""
    some = None if only is None else {d.isoformat() for d in only}
    _, held = manifest(spark, table_dir, version)
    names = [f.split("#")[0] for d, fs in sorted(held.items())
             if (first is None or d >= first.isoformat()) and (last is None or d <= last.isoformat()) and (some is None or d in some) for f in fs]
    return spark.read.option("mergeSchema", True).parquet(*[f"{table_dir}/{n}" for n in names]) if names else None


def compact(spark: SparkSession, table_dir: str, day: str, merge=lambda rows: rows, least: int = 2, unit: str = "day") -> list[str]:
    """Merge the folders of every day that has ``least`` or more into one, by ``merge``; returns the days. What a
    running stream adds meanwhile stays beside the merged folder."""
    _, held = manifest(spark, table_dir)
    many = {d: fs for d, fs in held.items() if len(fs) >= least}
    if not many:
        return []
    old = spark.read.option("mergeSchema", True).parquet(*[f"{table_dir}/{f.split('#')[0]}" for fs in many.values() for f in fs])
    written = _write(merge(old), table_dir, day, unit)

    def make(now):
        out = dict(now)
        for d, f in written.items():
            if not set(many[d]) <= set(now.get(d, [])):
                continue  # replaced meanwhile: the newer rows stand
            out[d] = [f + "".join("#" + x.split("#", 1)[1] for x in many[d] if "#" in x), *[x for x in now[d] if x not in many[d]]]
        return out

    change(spark, table_dir, make)
    return sorted(many)


def sweep(spark: SparkSession, table_dir: str, keep: int = 2) -> int:
    """Delete manifests older than the ``keep`` newest, and the folders none of those left names; returns how many
    folders went. Only for times when nobody writes or reads an older version."""
    have = versions(spark, table_dir)[-keep:]
    used = {f.split("#")[0] for v in have for fs in manifest(spark, table_dir, v)[1].values() for f in fs}
    jvm, fs, data = _hadoop(spark, f"{table_dir}/data")
    gone = 0
    for top in fs.listStatus(data) if fs.exists(data) else []:
        for s in fs.listStatus(top.getPath()):
            if f"data/{top.getPath().getName()}/{s.getPath().getName()}" not in used and s.getPath().getName().startswith("__day="):
                fs.delete(s.getPath(), True)
                gone += 1
    for v in versions(spark, table_dir):
        if v not in have:
            fs.delete(_hadoop(spark, f"{table_dir}/manifest/{v:012d}.json")[2], False)
    return gone
