"""Order-side composite queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import clean_code
from ..functions.numeric import round_even
from ..operators.allocate import rank_moves
from .base import ctx, store_needs, transfers


def q_reorder_need(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q01: per (store, item) weekly velocity, need and par floor."""
    n = store_needs(ctx(spark, sf_dir))
    return n.select("dept", "store", "item", "code_key", "on_hand",
                    round_even(F.col("vel"), 4).alias("vel"), round_even(F.col("need"), 4).alias("need"),
                    "par_cases", "has_par")


def q_transfer_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moves of the transfer plan."""
    _, moves = transfers(ctx(spark, sf_dir))
    return moves


def q_transfer_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item gross need, coverable by transfer, net buy."""
    items, _ = transfers(ctx(spark, sf_dir))
    return items


def item_median_cost(needs: DataFrame) -> DataFrame:
    return needs.groupBy("dept", "item").agg(F.median("cost").alias("cost"))


def q_transfer_plan_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves valued at the item's median cost, priority class then value."""
    t = ctx(spark, sf_dir)
    _, moves = transfers(t)
    return rank_moves(moves, item_median_cost(store_needs(t)))


def ranked_moves(t) -> DataFrame:
    """Q03 without its presentation order, for callers that aggregate it."""
    return rank_moves(transfers(t)[1], item_median_cost(store_needs(t)), ordered=False)


def q_store_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q04: each store orders its own need in full cases; removed items excluded."""
    return store_orders(ctx(spark, sf_dir)).orderBy("dept", "store", "supplier", F.col("wos").asc_nulls_last(), "item")


def store_orders(t) -> DataFrame:
    """Q04 without its presentation order."""
    n = store_needs(t).filter(F.col("need") > 0)
    n = n.join(t.remove_list.select("code_key").distinct(), "code_key", "left_anti")
    pack = F.when(F.col("case_pack") == 0, 1.0).otherwise(F.col("case_pack"))
    cases = F.greatest(F.ceil(F.col("need") / pack), F.lit(1)).cast("long")
    return (n.withColumn("order_cases", cases)
             .withColumn("order_units", round_even(F.col("order_cases") * pack, 0).cast("long"))
             .select("dept", F.trim("store").alias("store"), "supplier", "item",
                     clean_code("code").alias("product_code"),
                     F.col("on_hand").cast("long").alias("store_oh"),
                     F.when(F.col("vel") > 0, round_even(F.col("on_hand") / F.col("vel"), 1)).alias("wos"),
                     "order_cases", "order_units",
                     round_even(F.col("cost"), 2).alias("unit_cost"),
                     round_even(F.col("order_units") * F.col("cost"), 0).alias("order_usd")))
