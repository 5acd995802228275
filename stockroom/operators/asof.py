"""As-of joins of two ordered tables (J18 for many dates and sheets at once)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, right_on: str | None = None, *,
              tie: str | None = None, else_first: bool = False, ranges: int | None = None) -> DataFrame:
    """Every row of ``left`` with the row of ``right`` of the same ``by`` that has the latest ``right_on`` at or before ``on``.
    Of right rows with one key and time the one with the smallest ``tie`` counts (``tie`` must tell them apart). Without an earlier
    row the earliest of all is taken if ``else_first``, else nulls. Rows without a key or time match nothing.

    A merge of two ordered sides: both are put in one table, range partitioned by (key, time) - so a key with most of
    the rows is many ranges - and each row takes the last right row of its range; a range that begins without one takes over
    the last of the ranges before, from a table of one row per (key, range). No join looks at pairs of times."""
    right_on = right_on or on
    spark = left.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rest = [c for c in right.columns if c not in by]
    given = F.struct(*rest)
    known = right.filter(F.col(right_on).isNotNull())
    for c in by:
        known = known.filter(F.col(c).isNotNull())
    pick = F.min_by(given, F.col(tie)) if tie else F.min(given)
    once = known.groupBy(*by, F.col(right_on).alias("_t")).agg(pick.alias("_r"))
    mine = F.struct(*[c for c in left.columns if c not in by])
    both = (once.select(*by, "_t", F.lit(0).alias("_side"), F.lit(0).cast("bigint").alias("_spread"), "_r", F.lit(None).cast(left.select(mine.alias("m")).schema["m"].dataType).alias("_l"))
                .unionByName(left.select(*by, F.col(on).alias("_t"), F.lit(1).alias("_side"), F.xxhash64(*left.columns).alias("_spread"),
                                         F.lit(None).cast(once.schema["_r"].dataType).alias("_r"), mine.alias("_l"))))
    order = ["_t", "_side", "_spread"]
    ranged = durable(both.repartitionByRange(n, *by, *order).withColumn("_rng", F.spark_partition_id()))
    so_far = Window.partitionBy("_rng", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_here", F.last("_r", ignorenulls=True).over(so_far)).filter("_side = 1")
    lasts = ranged.groupBy(*by, "_rng").agg(F.max_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))).alias("_last"),
                                            F.min_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))).alias("_lead"))
    before = Window.partitionBy(*by).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by).orderBy("_rng").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = lasts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_rng").alias("_krng"),
                         F.last("_last", ignorenulls=True).over(before).alias("_before"),
                         F.first("_lead", ignorenulls=True).over(whole).alias("_first"))
    same = F.col("_rng") == F.col("_krng")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    found = F.coalesce("_here", "_before", *([F.when(F.col("_t").isNotNull(), F.col("_first"))] if else_first else []))
    out = local.join(carry, same, "left").withColumn("_found", found)
    return out.select(*[F.col(c) if c in by else F.col("_l")[c].alias(c) for c in left.columns],
                      *[F.col("_found")[c].alias(c) for c in rest if c not in left.columns])
