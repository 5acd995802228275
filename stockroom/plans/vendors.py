"""Vendor and store rollups of the order outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import parse_by_store
from ..operators.allocate import planned_moves
from ..session import write_table
from .base import ctx, store_needs
from .brief import inventory_snapshot
from .order import ranked_moves, store_orders
from .weekly import item_plan, weekly_order


def _orders(t) -> DataFrame:
    return weekly_order(store_needs(t), t)


def vendor_rollup(orders: DataFrame) -> DataFrame:
    """Per department and supplier - items, units, $; largest $ first."""
    o = orders.filter(F.col("section") == "order")
    return (o.groupBy("dept", "supplier").agg(F.count("*").alias("items"),
                                              F.sum("buy_units").alias("units"),
                                              F.sum(F.coalesce("net_buy_usd", F.lit(0.0))).alias("dollars"))
             .orderBy(F.col("dollars").desc(), "dept", "supplier"))


def store_vendor_rollup(store_orders: DataFrame) -> DataFrame:
    """Per (department, store, supplier) - items, cases, $."""
    return (store_orders.groupBy("dept", "store", "supplier")
                        .agg(F.count("*").alias("items"), F.sum("order_cases").alias("cases"),
                             F.sum(F.coalesce("order_usd", F.lit(0.0))).alias("dollars"))
                        .orderBy("dept", "store", F.col("dollars").desc(), "supplier"))


def store_receiving_rollup(ranked_moves: DataFrame) -> DataFrame:
    """Per receiving store - moves, value received, stockouts."""
    return (ranked_moves.groupBy("dept", "to_store")
                        .agg(F.count("*").alias("items"),
                             F.sum(F.coalesce("value", F.lit(0.0))).alias("transfer_in_value"),
                             F.count_if(F.col("priority") == "STOCKOUT").alias("stockouts"))
                        .orderBy(F.col("transfer_in_value").desc(), "dept", "to_store"))


def headline_kpis(orders: DataFrame, moves: DataFrame) -> DataFrame:
    """One row per department with the app's headline numbers, each a conditional
    aggregate over the order sections and the moves."""
    o = orders.groupBy("dept").agg(
        F.count_if(F.col("section") == "order").alias("items"),
        F.sum(F.when(F.col("section") == "order", F.col("buy_units"))).alias("units"),
        F.sum(F.when(F.col("section") == "order", F.col("net_buy_usd"))).alias("net_buy"),
        F.count_if(F.col("section") == "wait").alias("wait_items"),
        F.sum(F.when(F.col("section") == "wait", F.col("net_buy_usd"))).alias("wait_buy"),
        F.count_if((F.col("section") == "order") & (F.length("review") > 0)).alias("review_items"))
    m = moves.groupBy("dept").agg(
        F.count("*").alias("transfers"), F.sum("transfer_in").alias("rebalance_units"),
        F.count_if(F.col("priority") == "STOCKOUT").alias("stockouts"),
        F.count_if(F.col("priority") == "Low <2wk").alias("low"))
    m = m.withColumn("routine", F.col("transfers") - F.col("stockouts") - F.col("low"))
    return o.join(m, "dept", "full_outer")


def vendor_order(orders: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Q17 + J17: order lines of every vendor with that vendor's totals, each line's
    on-hand by store and an out-of-stock flag (no store holds any and chain OH <= 0)."""
    o = orders.filter(F.col("section") == "order")
    s = snapshot.select(F.col("dept").alias("_sd"), F.lower(F.trim("item")).alias("_si"),
                        F.col("by_store_oh").alias("_bs"), F.col("chain_oh").alias("_coh"))
    j = o.join(s, (o["dept"] == s["_sd"]) & (F.lower(F.trim(o["item"])) == s["_si"]), "left")
    # vendor totals are an aggregate joined back (a vendor may hold a large share of the
    # lines; a whole-vendor window would put all of them in one task)
    tot = o.groupBy("dept", "supplier").agg(F.sum("buy_units").alias("vendor_units"),
                                            F.sum("net_buy_usd").alias("vendor_total"))
    j = j.join(tot, ["dept", "supplier"])
    parsed = parse_by_store(F.col("_bs"))
    return j.select(
        "dept", "supplier", "item", "buy_units", "buy_cases", "net_buy_usd", "vendor_units", "vendor_total",
        F.array_join(F.transform(parsed, lambda x: F.concat(x["store"], F.lit(":"), x["qty"].cast("string"))), ";")
         .alias("by_store"),
        ((F.size(parsed) == 0) & (F.coalesce(F.col("_coh"), F.lit(0)) <= 0)).alias("oos"))


def store_order(store_orders: DataFrame) -> DataFrame:
    """Q17 (store side): each store x supplier order with its totals."""
    keys = ["dept", "store", "supplier"]
    tot = store_orders.groupBy(*keys).agg(F.sum("order_units").alias("total_units"),
                                          F.sum("order_cases").alias("total_cases"),
                                          F.sum("order_usd").alias("total_usd"))
    return store_orders.join(tot, keys).select(
        "dept", "store", "supplier", "item", "product_code", "store_oh", "wos", "order_cases", "order_units",
        "order_usd", "total_units", "total_cases", "total_usd")


# ---- registered queries -----------------------------------------------------------------

def q_vendor_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_rollup(_orders(ctx(spark, sf_dir)))


def q_store_vendor_rollup(spark, sf_dir):
    return store_vendor_rollup(store_orders(ctx(spark, sf_dir)))


def q_store_receiving_rollup(spark, sf_dir):
    return store_receiving_rollup(ranked_moves(ctx(spark, sf_dir)))


def q_headline_kpis(spark, sf_dir):
    t = ctx(spark, sf_dir)
    needs = store_needs(t)
    planned = write_table(item_plan(needs), "item-plan")
    return headline_kpis(weekly_order(needs, t, planned=planned), planned_moves(planned))


def q_vendor_order(spark, sf_dir):
    t = ctx(spark, sf_dir)
    orders = write_table(_orders(t).filter(F.col("section") == "order"), "vendor-order-lines")
    return vendor_order(orders, inventory_snapshot(t))


def q_store_order(spark, sf_dir):
    return store_order(store_orders(ctx(spark, sf_dir)))
