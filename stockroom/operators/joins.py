"""Lookups against reference lists.

The reference lists are keyed by product code and are small next to the snapshot, but
their size is not fixed, so no broadcast is forced: the optimizer broadcasts them from
statistics and AQE switches to a broadcast at run time when the built side is under the
threshold, else it keeps a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_even
from .rollups import dedupe_keep, first_by


def last_rows(lst: DataFrame, keys: list[str], order: str = "list_row") -> DataFrame:
    """A reference list with one row per key, the last in list order."""
    return dedupe_keep(lst, keys, order, keep="last").drop(order)


def _deal_columns() -> list[Column]:
    unit_regular = F.col("case_cost") / F.col("units_case")
    disc = F.when(unit_regular > 0, round_even((F.lit(1.0) - F.col("net_unit") / unit_regular) * 100, 1))
    gm = F.when(F.col("retail") > 0, round_even((F.col("retail") - F.col("net_unit")) / F.col("retail") * 100, 1))
    return [disc.alias("discount_pct"), gm.alias("buyer_gm_pct"),
            F.concat(F.lit("case of "), F.col("units_case").cast("string")).alias("deal")]


def buyer_terms(deals: DataFrame) -> DataFrame:
    """J01 (deal side): discount %, deal text per code from the buyer master; last row wins."""
    return last_rows(deals, ["code_key"]).select("code_key", *_deal_columns())


def code_terms(inv: DataFrame, ads: DataFrame, buy_months: DataFrame, deals: DataFrame, remove_list: DataFrame,
               new_list: DataFrame) -> DataFrame:
    """J01-J03, J11 and J19 as one row for each code: first positive shelf price in file order (``retail``), ad
    kind and weeks-of-supply target, sorted buy months (NULL = no constraint), the buyer's deal terms, and whether
    the code is on the remove and the new list. The last list row of a code wins.

    The lists are stacked and reduced by one aggregate on the code, which combines map-side, so an item plan meets
    all of them in one join, and a code that fills a list is never one task's."""
    months = F.array_sort(F.collect_set("month"))
    stacked = [ads.select("code_key", F.col("list_row").alias("_ad_row"),
                          F.struct(F.col("kind").alias("ad_kind"), F.col("target_wos").alias("ad_target")).alias("_ad")),
               buy_months.select("code_key", F.col("m").cast("int").alias("month")),
               deals.select("code_key", F.col("list_row").alias("_deal_row"), F.struct(*_deal_columns()).alias("_deal")),
               remove_list.select("code_key", F.lit(True).alias("_removed")),
               new_list.select("code_key", F.lit(True).alias("_new"))]
    rows = inv.filter(F.col("price") > 0).select("code_key", "ingest_row", "price")
    for lst in stacked:
        rows = rows.unionByName(lst, allowMissingColumns=True)
    return (rows.filter(F.col("code_key").isNotNull()).groupBy("code_key").agg(
                first_by("price").alias("retail"), F.max_by("_ad", "_ad_row").alias("_ad"), months.alias("_months"),
                F.max_by("_deal", "_deal_row").alias("_deal"), F.bool_or("_removed").alias("_removed"), F.bool_or("_new").alias("_new"))
            .select("code_key", "retail", "_ad.*", F.when(F.size("_months") > 0, F.col("_months")).alias("buy_months"), "_deal.*",
                    F.coalesce("_removed", F.lit(False)).alias("on_remove"), F.coalesce("_new", F.lit(False)).alias("is_new")))


def apply_overrides(buy: DataFrame, decisions: DataFrame) -> DataFrame:
    """Buyer decisions keyed by (lower(trim(dept)), lower(trim(item))).

    skip drops the line; qty replaces units (max(0, int(q)); unparseable keeps the line's),
    cases = units / pack (1 dp), $ = units x cost (0 dp); approve/qty clear the review text;
    fix with a note replaces it with 'FIX REQUESTED: <note>'."""
    d = decisions.select(F.lower(F.trim("dept")).alias("_dd"), F.lower(F.trim("item")).alias("_di"),
                         F.col("action").alias("_act"), F.col("qty").alias("_qty"), F.col("note").alias("_note"))
    j = buy.join(d, (F.lower(F.trim(buy["dept"])) == d["_dd"]) & (F.lower(F.trim(buy["item"])) == d["_di"]), "left")
    j = j.filter(F.coalesce(F.col("_act"), F.lit("")) != "skip")
    q = F.col("_qty").cast("string").try_cast("double")
    is_qty = (F.col("_act") == "qty") & F.col("_qty").isNotNull()
    new_units = F.when(q.isNotNull(), F.greatest(q.cast("bigint"), F.lit(0)).cast("bigint")).otherwise(F.col("buy_units"))
    pack = F.when(F.col("case") != 0, F.col("case")).otherwise(F.lit(1.0))
    j = (j.withColumn("buy_units", F.when(is_qty, new_units).otherwise(F.col("buy_units")))
          .withColumn("buy_cases", F.when(is_qty, round_even(F.col("buy_units") / pack, 1)).otherwise(F.col("buy_cases")))
          .withColumn("net_buy_usd", F.when(is_qty, round_even(F.col("buy_units") * F.col("cost"), 0))
                      .otherwise(F.col("net_buy_usd")))
          .withColumn("review", F.when(F.col("_act").isin("approve", "qty"), F.lit(""))
                      .when((F.col("_act") == "fix") & F.col("_note").isNotNull() & (F.col("_note") != ""),
                            F.concat(F.lit("FIX REQUESTED: "), F.col("_note")))
                      .otherwise(F.col("review"))))
    return j.drop("_dd", "_di", "_act", "_qty", "_note")
