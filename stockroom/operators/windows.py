"""Ordered operators: running totals, top-N, ranking.

Running totals over a *coarse* key (a department has millions of items at scale) must not
pull a whole key into one task, so ``running_sum`` is a two-level scan: rows are range
partitioned on (key, order), each range computes local running sums, and a small table of
per-range totals supplies the offset of every earlier range. The range a row falls in is
pinned by a checkpoint, so a recomputed task sees the same split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def _names(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def running_sum(df: DataFrame, keys: list[str], order: list, value: str, out: str, *,
                exclusive: bool = False, ranges: int | None = None) -> DataFrame:
    """``out`` = sum of ``value`` over rows of the same ``keys`` up to this row in ``order``
    (inclusive; ``exclusive=True`` sums the preceding rows only). ``order`` must be a total
    order within a key (end it with a unique column)."""
    spark = df.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = durable(df.repartitionByRange(n, *_names(keys), *_names(order))
                       .withColumn("_rng", F.spark_partition_id()))
    frame_end = -1 if exclusive else Window.currentRow
    w = Window.partitionBy("_rng", *keys).orderBy(*_names(order)).rowsBetween(Window.unboundedPreceding, frame_end)
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(w), F.lit(0)))
    totals = ranged.groupBy(*keys, "_rng").agg(F.sum(value).alias("_t"))
    wo = Window.partitionBy(*keys).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"_at_{k}") for k in [*keys, "_rng"]], F.coalesce(F.sum("_t").over(wo), F.lit(0)).alias("_off"))
    same = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in [*keys, "_rng"]]  # rows without a key are a key
    return local.join(offsets, same).withColumn(out, F.col("_local") + F.col("_off")).select(*df.columns, out)


def top_n(df: DataFrame, keys: list[str], order: list, n: int, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows per key by ``order`` (row_number, so exactly n on ties).
    Spark plans this as a per-partition group-limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*_names(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def priority_order(strategy: str) -> list[Column]:
    """Sort keys of a buy list for a ranking strategy."""
    if strategy == "margin":
        return [F.col("gm_pct").desc_nulls_last(), F.col("profit_protected").desc_nulls_last()]
    if strategy == "deals":
        return [F.col("on_deal").cast("int").desc(), F.col("profit_protected").desc_nulls_last()]
    if strategy == "balanced":
        return [F.col("profit_protected").desc_nulls_last()]
    return [F.col("wos").asc_nulls_last(), F.col("profit_protected").desc_nulls_last()]
