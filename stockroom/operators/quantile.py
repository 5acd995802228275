"""Exact quantile per group without holding a group in one aggregation buffer.

``percentile`` is exact but keeps every distinct value of a group in one buffer, which a
hot group (a third of all rows) cannot afford; ``percentile_approx`` is bounded but only
approximate. This combines them: the approximate sketch brackets the target rank, rows
below the bracket are only counted, and only the values inside the bracket - a slice of
about ``8/accuracy`` of the group, collapsed to distinct values with their counts - are
ranked to read off the exact order statistics. Small groups (where the sketch guarantee
is loose) use their whole range, which is small by definition.

The result is linear interpolation between the order statistics at 0-based ranks
floor(p*(n-1)) and the next one - the same as pandas ``quantile`` and SQL
``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 50000


def exact_quantile(df: DataFrame, value: str, p: float, keys: list[str], *,
                   accuracy: int = SKETCH_ACCURACY, out: str = "q") -> DataFrame:
    """Per ``keys``: the exact ``p``-quantile of non-null ``value`` (one row per key)."""
    x = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    d = 4.0 / accuracy
    small = 4 * accuracy
    stats = x.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_x", F.array(F.lit(max(p - d, 0.0)), F.lit(min(p + d, 1.0))), accuracy).alias("_br"))
    stats = (stats.withColumn("_lo", F.when(F.col("_n") > small, F.col("_br")[0]))
                  .withColumn("_hi", F.when(F.col("_n") > small, F.col("_br")[1]))
                  .withColumn("_pos", F.lit(p) * (F.col("_n") - 1))
                  .withColumn("_k", F.floor("_pos"))
                  .withColumn("_frac", F.col("_pos") - F.col("_k"))
                  .drop("_br"))
    j = x.join(stats, keys)
    below = j.filter(F.col("_x") < F.col("_lo")).groupBy(*keys).agg(F.count("*").alias("_below"))
    inside = (j.filter((F.col("_lo").isNull() | (F.col("_x") >= F.col("_lo")))
                       & (F.col("_hi").isNull() | (F.col("_x") <= F.col("_hi"))))
               .groupBy(*keys, "_x").agg(F.count("*").alias("_c")))
    w = Window.partitionBy(*keys).orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (inside.join(below, keys, "left").join(stats.select(*keys, "_k", "_frac"), keys)
                    .withColumn("_start", F.coalesce(F.col("_below"), F.lit(0))
                                + F.coalesce(F.sum("_c").over(w), F.lit(0))))
    # value at rank r: start <= r < start + count
    at = lambda r: F.max(F.when((F.col("_start") <= r) & (r < F.col("_start") + F.col("_c")), F.col("_x")))
    lo_v = at(F.col("_k"))
    hi_v = at(F.col("_k") + 1)
    g = ranked.groupBy(*keys).agg(lo_v.alias("_a"), hi_v.alias("_b"), F.max("_frac").alias("_f"))
    return g.select(*keys, F.when(F.col("_f") > 0, F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f"))
                    .otherwise(F.col("_a")).alias(out))
