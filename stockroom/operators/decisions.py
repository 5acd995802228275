"""Buyer decisions folded from the append-only change log.

Every log entry fully determines the state it leaves behind: a set event (approve, qty,
skip, fix) replaces the key's decision with its own values; an accepted undo restores the
``prev`` the undone entry stored (or removes the decision when it stored none). So the
current state of a key is just its *last accepted entry* - a ``max_by`` aggregate, not a
sequential replay, and it partially aggregates before the shuffle even when one key holds
a large share of the log.

An undo is accepted once per target (a second undo of the same entry is refused) and only
when the target is a set event (undo entries themselves cannot be undone). Undoing an entry
after later edits restores that entry's older ``prev``, as the original tool does.

Log columns: id (orders the log), ts, dept, item, action, qty, note, target_id (undo only),
prev_action, prev_qty, prev_note.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECISION_SCHEMA = "dept string, item string, action string, qty string, note string"


def read_decisions(spark, path: str, *, multiline: bool = False) -> DataFrame:
    """Buyer decisions from JSON files, one object per line (``multiline``: one array per file);
    quantities stay text, as buyers type them."""
    return spark.read.schema(DECISION_SCHEMA).option("multiLine", multiline).json(path)


SET_ACTIONS = ["approve", "qty", "skip", "fix"]


def decision_key(dept, item) -> list[F.Column]:
    """Decisions are keyed case- and space-insensitively."""
    return [F.lower(F.trim(dept)).alias("dept_key"), F.lower(F.trim(item)).alias("item_key")]


def accepted_undos(log: DataFrame) -> DataFrame:
    """First undo per target whose target is a set event: undo id, target id and the
    target's stored prev."""
    undos = (log.filter((F.col("action") == "undo") & F.col("target_id").isNotNull())
                .groupBy("target_id").agg(F.min(F.struct("id", "ts")).alias("u"))
                .select("target_id", F.col("u.id").alias("undo_id"), F.col("u.ts").alias("undo_ts")))
    sets = log.filter(F.col("action").isin(SET_ACTIONS)).select(
        F.col("id").alias("target_id"), "dept", "item", "prev_action", "prev_qty", "prev_note")
    return undos.join(sets, "target_id")


def decision_state(log: DataFrame) -> DataFrame:
    """Current decision per (dept, item) - action, qty, note, the id and ts of the entry
    that set it. Keys whose last accepted entry removed the decision are absent."""
    sets = log.filter(F.col("action").isin(SET_ACTIONS)).select(
        "id", "ts", "dept", "item", "action", "qty", "note")
    undos = accepted_undos(log).select(
        F.col("undo_id").alias("id"), F.col("undo_ts").alias("ts"), "dept", "item",
        F.col("prev_action").alias("action"), F.col("prev_qty").alias("qty"), F.col("prev_note").alias("note"))
    entries = sets.unionByName(undos)
    last = (entries.select(*decision_key(F.col("dept"), F.col("item")), "id",
                           F.struct("id", "ts", "dept", "item", "action", "qty", "note").alias("e"))
                   .groupBy("dept_key", "item_key").agg(F.max_by("e", "id").alias("e")))
    last = last.filter(F.col("e.action").isNotNull())
    return (last.select("e.dept", "e.item", "e.action", "e.qty", "e.note", F.col("e.id").alias("set_by"), "e.ts"))
