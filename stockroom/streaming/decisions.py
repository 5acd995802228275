"""Buyer decisions kept current from a change-log stream, with state for each key.

One query holds the log's effect as state and never reads the log again:

* an undo names the entry it undoes, not its key; a stream-stream join with the entries routes it to its target's (dept,
  item), whichever of the two comes first;
* a stateful operator keyed by (dept, item) applies the rules of W07: the last accepted entry (by id) decides, an accepted
  undo brings back what its target had stored, and the first undo of a target counts - a second one is refused. An undo
  that is delivered after a later undo of the same target takes its place. Entries delivered twice change nothing.
* an entry that says which entry its writer had last seen (``expected``) is refused as a conflict if that is no longer the
  newest of its key; ``submit`` reads again and retries, as the original tool does on a version conflict.

State is kept in RocksDB, each key's newest entry with the latest ids and undos, the older ones in pages of ids, so a micro-batch
reads and writes the pages it touches, and asks for them once a key, not once an entry. ``read_state`` reads the newest
entry of every key from the state itself; every change, refusal and conflict is also appended to the change feed, one
folder a micro-batch (a replay overwrites its own).
"""

from __future__ import annotations

import json
import struct
import sys
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.decisions import SET_ACTIONS, decision_key
from . import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the library

LOG_SCHEMA = ("id bigint, ts timestamp_ntz, dept string, item string, action string, qty int, note string, "
              "target_id bigint, prev_action string, prev_qty int, prev_note string")
INPUT_SCHEMA = LOG_SCHEMA + ", expected bigint"
ENTRY = "id bigint, ts timestamp_ntz, dept string, item string, action string, qty int, note string"
FEED_SCHEMA = "kind string, dept_key string, item_key string, " + ENTRY + ", target_id bigint"
FIELDS = ["id", "ts", "dept", "item", "action", "qty", "note"]
PACKED = "id bigint, packed string"
IDS = "binary"  # 64-bit numbers, little-endian
UNDOS = f"array<struct<target_id bigint, {PACKED}>>"
INDEX = "array<struct<bound bigint, page int>>"
HEAD = f"{ENTRY}, packed string, under struct<{PACKED}>, ids {IDS}, id_index {INDEX}, undos {UNDOS}, undo_index {INDEX}"
PAGE = 128  # ids of a page, about
#: One store for a partition of the join instead of four, a commit that writes what a micro-batch changed, and native memory that
#: does not grow with the state.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
              "spark.sql.streaming.join.stateFormatVersion": "3"}
TRIES = 4


class Paged:
    """Values by id under one key of the state. The highest ids are kept inline with the key's newest entry, up to twice ``PAGE``; the
    others lie in pages of a map state that do not overlap, so a call reads and writes the pages its ids fall in, each once.
    ``index`` has a (bound, page) for each page: it holds the ids below its bound that no page before it holds."""

    def __init__(self, pages, index, inline, load, dump):
        self.pages, self.load, self.dump = pages, load, dump
        self.index = [tuple(x) for x in index]
        self.bounds = [x[0] for x in self.index]
        self.read = {None: load(inline)}
        self.changed = set()

    def page(self, n) -> dict:
        if n not in self.read:
            self.read[n] = self.load(self.pages.getValue((n,))[0])
        return self.read[n]

    def name(self, k) -> int | None:
        i = bisect_right(self.bounds, k)
        return None if i == len(self.index) else self.index[i][1]

    def __contains__(self, k) -> bool:
        return k in self.page(self.name(k))

    def __getitem__(self, k):
        return self.page(self.name(k))[k]

    def __setitem__(self, k, v) -> None:
        n = self.name(k)
        self.page(n)[k] = v
        self.changed.add(n)

    def __delitem__(self, k) -> None:
        n = self.name(k)
        del self.page(n)[k]
        self.changed.add(n)

    def values(self) -> Iterator:
        for n in [*(x[1] for x in self.index), None]:
            yield from self.page(n).values()

    def stored(self) -> tuple[list, list]:
        """Writes the pages that changed, those over twice ``PAGE`` cut up; returns the index and what stays inline."""
        for n in [n for n in self.changed if len(self.read[n]) > 2 * PAGE]:
            held = sorted(self.read[n].items())
            parts = [dict(held[i:i + PAGE]) for i in range(0, len(held), PAGE)]
            names = [len(self.index) + i for i in range(len(parts) - 1)]
            names = [*names, None] if n is None else [n, *names]
            at = len(self.index) if n is None else [x[1] for x in self.index].index(n)
            ends = [min(p) for p in parts[1:]] + ([] if n is None else [self.index[at][0]])
            self.index[at:at + (n is not None)] = list(zip(ends, names))
            self.read.update(zip(names, parts))
            self.changed.update(names)
        for n in self.changed - {None}:
            self.pages.updateValue((n,), (self.dump(self.read[n]),))
        return self.index, self.dump(self.read[None])


def _ids_in(held: bytes) -> dict:
    return dict.fromkeys(struct.unpack(f"<{len(held) // 8}q", held))


def _ids_out(held: dict) -> bytes:
    return struct.pack(f"<{len(held)}q", *held)


def _undos_in(held) -> dict:
    return {u[0]: (u[1], u[2]) for u in held}


def _undos_out(held: dict) -> list:
    return [(t, *e) for t, e in held.items()]


def whole(entry: tuple) -> tuple:
    """The fields of an (id, JSON) pair, as ``routed`` packed them."""
    said = json.loads(entry[1])
    said["ts"] = datetime.fromisoformat(said["ts"]) if "ts" in said else None
    return entry[0], *(said.get(f) for f in FIELDS[1:])


class KeyState(StatefulProcessor):
    """The decisions of one (dept, item): its newest entry, the newest set under it if that is an undo, the ids of its accepted
    entries and the accepted undo of each target. A set is never taken back, so older sets are known by their ids alone.
    Entries stay packed until one of their fields is needed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", HEAD)
        self.id_pages = handle.getMapState("id_pages", "page int", f"held {IDS}")
        self.undo_pages = handle.getMapState("undo_pages", "page int", f"held {UNDOS}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.newest.get() if self.newest.exists() else None
        before, top, under, ids, id_index, undos, undo_index = (None, None, None, b"", [], [], []) if held is None else (
            tuple(held[:len(FIELDS)]), (held[0], held[-6]), *held[-5:])
        last_set = top if under is None else tuple(under)
        entries = Paged(self.id_pages, id_index, ids, _ids_in, _ids_out)
        undone = Paged(self.undo_pages, undo_index, undos, _undos_in, _undos_out)
        for id, target, expected, packed in sorted((unpacked(r[-1]) for r in rows), key=lambda r: r[0]):
            entry = (id, packed)
            if id in entries:
                continue  # delivered again
            if expected is not None and expected != (-1 if top is None else top[0]):
                yield self.said("conflict", key, entry, target)
                continue
            if target is not None and target in undone:
                out = undone[target]
                if out[0] <= id:
                    yield self.said("refused", key, entry, target)
                    continue
                del entries[out[0]]  # a later undo had come first: it is refused after all
                yield self.said("refused", key, out, target)
                if top[0] == out[0]:
                    left = [e for e in undone.values() if e[0] != out[0]]
                    top = max(left if last_set is None else [*left, last_set], key=lambda e: e[0], default=None)
            if target is not None:
                undone[target] = entry
            elif last_set is None or id > last_set[0]:
                last_set = entry
            entries[id] = None
            if expected is not None:
                yield self.said("accepted", key, entry, target)
            if top is None or id > top[0]:
                top = entry
        if not entries.changed:
            return
        id_index, ids = entries.stored()
        undo_index, undos = undone.stored()
        newest = whole(top)
        self.newest.update((*newest, top[1], None if top == last_set else last_set, ids, id_index, undos, undo_index))
        if newest != before:
            yield self.said("state", key, top, None)

    @staticmethod
    def said(kind: str, key, entry: tuple, target) -> Row:
        return Row(kind=kind, dept_key=key[0], item_key=key[1], **dict(zip(FIELDS, whole(entry))), target_id=target)

    def close(self) -> None:
        pass


def unpacked(line: str) -> tuple:
    """Id, target, expected and the packed fields of a line of ``routed``."""
    id, target, expected, packed = line.split(",", 3)
    return int(id), int(target) if target else None, int(expected) if expected else None, packed


def routed(log: DataFrame) -> DataFrame:
    """The log's entries with the key they act on: sets with their own, undos with their target's and what that had stored. What
    the key's state does not look at is packed as JSON: Python reads rows value by value, and most of these are never needed."""
    sets = log.filter(F.col("action").isin(SET_ACTIONS))
    own = sets.select(*decision_key(F.col("dept"), F.col("item")), *FIELDS, F.lit(None).cast("bigint").alias("target_id"), "expected")
    undos = log.filter((F.col("action") == "undo") & F.col("target_id").isNotNull()).select(
        F.col("id").alias("undo_id"), F.col("ts").alias("undo_ts"), F.col("target_id").alias("undone"), F.col("expected").alias("undo_expected"))
    met = undos.join(sets, F.col("undone") == F.col("id"))
    back = met.select(*decision_key(F.col("dept"), F.col("item")), F.col("undo_id").alias("id"), F.col("undo_ts").alias("ts"), "dept", "item",
                      F.col("prev_action").alias("action"), F.col("prev_qty").alias("qty"), F.col("prev_note").alias("note"),
                      F.col("undone").alias("target_id"), F.col("undo_expected").alias("expected"))
    packed = F.to_json(F.struct(*FIELDS[1:]), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    numbers = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("id", "target_id", "expected")]
    return own.unionByName(back).select("dept_key", "item_key", F.concat_ws(",", *numbers, packed).alias("line"))


def start(spark: SparkSession, source_dir: str, feed_dir: str, checkpoint_dir: str, *,
          files_per_trigger: int | None = None, available_now: bool = True, partitions: int | None = None):
    """Run the stream: parquet files of log entries in ``source_dir`` -> keyed state in ``checkpoint_dir``, change feed in
    ``feed_dir``. ``partitions``: those of the state (the session's shuffle partitions if not given); they hold for the stream's life."""
    reader = spark.readStream.schema(INPUT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    feed = (routed(reader.parquet(source_dir)).groupBy("dept_key", "item_key")
            .transformWithState(statefulProcessor=KeyState(), outputStructType=FEED_SCHEMA, outputMode="Append", timeMode="None"))
    w = feed.writeStream.outputMode("append").foreachBatch(batches.append_partials(feed_dir, lambda b: b)).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    own = STATE_CONF | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    was = {k: spark.conf.get(k, None) for k in own}
    try:  # the stream takes the settings it starts with; the session keeps its own
        for k, v in own.items():
            spark.conf.set(k, v)
        return w.start()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_newest(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """The newest accepted entry of every key, read from the stream's state."""
    state = (spark.read.format("statestore").option("path", checkpoint_dir).option("operatorId", state_operator(spark, checkpoint_dir))
             .option("stateVarName", "newest").load())
    return state.select("key.dept_key", "key.item_key", *[f"value.{f}" for f in FIELDS])


def state_operator(spark: SparkSession, checkpoint_dir: str) -> int:
    """Which of the query's stateful operators is the keyed one."""
    found = (spark.read.format("state-metadata").load(checkpoint_dir).filter("operatorName = 'transformWithStateInPySparkExec'")
             .select("operatorId").distinct().collect())
    return found[0][0]


def read_state(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """The current decision of every key that has one."""
    return (read_newest(spark, checkpoint_dir).filter("action IS NOT NULL")
            .select("dept", "item", "action", "qty", "note", F.col("id").alias("set_by"), "ts"))


def read_feed(spark: SparkSession, feed_dir: str) -> DataFrame:
    """All changes, refusals and conflicts so far."""
    t = batches.read_partials(spark, feed_dir)
    return spark.createDataFrame([], FEED_SCHEMA + ", batch_id int") if t is None else t


def submit(spark: SparkSession, entries: DataFrame, source_dir: str, checkpoint_dir: str, advance, feed_dir: str, tries: int = TRIES) -> int:
    """Land ``entries`` (as the log, ids ascending and new) so that each is accepted only on top of the state its writer saw.

    Every try reads the state, stamps each entry with the newest id of its key (-1: none), lands them and lets the
    stream ``advance``; those that another writer overtook come back as conflicts and are tried again. Returns how
    many tries it took; raises RuntimeError if some still conflict after ``tries``."""
    left = entries.collect()  # what one buyer sends
    for n in range(1, tries + 1):
        sent = spark.createDataFrame(left, entries.schema)
        key = [c.alias(f"__{k}") for c, k in zip(decision_key(F.col("dept"), F.col("item")), ("dept", "item"))]
        seen = read_newest(spark, checkpoint_dir).select(F.col("dept_key").alias("__d"), F.col("item_key").alias("__i"), F.col("id").alias("__seen"))
        stamped = (sent.select(*sent.columns, *key).join(seen, (F.col("__dept") == F.col("__d")) & (F.col("__item") == F.col("__i")), "left")
                       .withColumn("expected", F.coalesce("__seen", F.lit(-1))).select(*sent.columns, "expected"))
        stamped.write.mode("append").parquet(source_dir)
        advance()
        accepted = {r[0] for r in read_feed(spark, feed_dir).filter((F.col("kind") == "accepted") & F.col("id").isin([r["id"] for r in left]))
                    .select("id").collect()}
        left = [r for r in left if r["id"] not in accepted]
        if not left:
            return n
    raise RuntimeError(f"entries still conflict after {tries} tries")
