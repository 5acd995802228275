"""Tables made of mergeable partial results, one folder per micro-batch.

A stream appends each micro-batch's partial aggregate under ``batch_id=<id>`` and readers merge the
partials. A replayed micro-batch overwrites its own folder, so delivery at least once changes nothing,
and no row depends on which file or batch another row of its group came in: nothing is ever too late.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import read_parquet_or_none


def append_partials(table_dir: str, partial: Callable[[DataFrame], DataFrame]):
    """A foreachBatch sink that writes ``partial(batch)`` to the micro-batch's own folder."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(os.path.join(table_dir, f"batch_id={batch_id}"))
    return sink


def read_partials(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """All partials written so far (with ``batch_id``), or None before the first."""
    return read_parquet_or_none(spark, table_dir)


def compact(spark: SparkSession, table_dir: str, out_dir: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Write the merged partials of ``table_dir`` as one batch of a new table (many small batches
    become one; a stream that goes on numbers its batches from 0, so -1 is free)."""
    t = read_partials(spark, table_dir)
    if t is not None:
        merge(t).write.mode("overwrite").parquet(os.path.join(out_dir, "batch_id=-1"))


def run(spark: SparkSession, schema: str, source_dir: str, checkpoint_dir: str, sink, *, files_per_trigger: int | None,
        available_now: bool, interval: str):
    """Start a file stream of ``schema`` rows into ``sink``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    w = reader.parquet(source_dir).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
