"""Q02 weekly order: transfer-first buy list per department, in the order of the rules.

1 item rollup (A01)  2 transfer totals (J05)  3 case rounding  4 ad floor (J11)
5 buy-month stock-up (J19, F06)  6 "enough stock" cut  7 margin, deal terms (J01)
8 keep bought lines, split discontinued (J02)  9 buy-month timing  10 review reasons
11 buyer overrides (J10, optional)  12 priority ranking (W08) and budget prefix (W03).

Everything is one plan: one shuffle by (dept, item) for the rollup and the allocator
(both group the same rows), the list lookups are joins on code, and the only ordered step
(the budget running total) runs as a range-partitioned scan, never as a one-task window.
"""

from __future__ import annotations

import datetime
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.codes import clean_code
from ..functions.months import month_abbr, weeks_to_next_buy_month
from ..functions.numeric import round_even, trend_pct
from ..functions.text import join_text
from ..operators.allocate import planned_items
from ..operators.joins import apply_overrides, code_terms
from ..operators.rollups import item_aggregates, with_case
from ..operators.windows import priority_order, running_sum
from ..operators.decisions import read_decisions
from ..session import checkpoint_dir, write_table
from ..sources.fixtures import AS_OF
from ..operators.clean import src_inventory
from .base import ctx, store_needs



def _empty_months() -> Column:
    return F.array().cast("array<int>")


def _money_text(c: Column) -> Column:
    """'$4,000' style: thousands separators, no decimals (value already whole)."""
    return F.concat(F.lit("$"), F.format_number(c, 0))


def _recase(df: DataFrame, mask: Column) -> DataFrame:
    """Re-case the masked lines with ceil and recompute units and $."""
    cases = F.ceil(F.coalesce(F.col("net_buy") / F.col("case"), F.lit(0.0))).cast("double")
    units = (cases * F.col("case")).cast("bigint")
    return df.withColumns({
        "buy_cases": F.when(mask, cases).otherwise(F.col("buy_cases")),
        "buy_units": F.when(mask, units).otherwise(F.col("buy_units")),
        "net_buy_usd": F.when(mask, round_even(units * F.col("cost"), 0)).otherwise(F.col("net_buy_usd"))})


def item_plan(needs: DataFrame) -> DataFrame:
    """A01 + W01 of every item in one groupBy by (dept, item)."""
    return with_case(planned_items(needs, extra=item_aggregates()))


def list_terms(t) -> DataFrame:
    """All per-code lists of the order, one row for each code, written once."""
    return t.derived("code_terms", lambda t: write_table(
        code_terms(src_inventory(t.inventory), t.ad_list, t.buy_months, t.deals, t.remove_list, t.new_list), "code-terms"))


def order_lines(planned: DataFrame, t, *, as_of: str = AS_OF, decisions: DataFrame | None = None,
                target_weeks: float = config.TARGET_WEEKS) -> DataFrame:
    """All bought-or-considered lines of every department with a ``section`` column:
    order | removed | wait, from the item plan. Lines cut to zero units are not returned."""
    cur_month = datetime.date.fromisoformat(as_of).month
    g = planned.drop("_moves")
    wk_vel, v90 = F.col("u30") * 7 / 30, F.col("u90") * 7 / 90
    g = g.withColumns({
        "wk_vel": wk_vel,
        "wos": F.when(wk_vel > 0, round_even(F.col("chain_oh") / wk_vel, 1)),
        "_v90": v90,
        "trend": trend_pct(wk_vel, v90),
        "ly_wk": round_even(F.col("u_ly4") / 4.0, 1)})
    # 2-3: transfer totals and case rounding
    g = g.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("gross_need", "transfer", "net_buy")})
    cases = round_even(F.col("net_buy") / F.col("case"), 0)
    units = (cases * F.col("case")).cast("bigint")
    g = g.withColumns({
        "gross_usd": round_even(F.col("gross_need") * F.col("cost"), 0),
        "transfer_usd": round_even(F.col("transfer") * F.col("cost"), 0),
        "buy_cases": cases,
        "buy_units": units,
        "net_buy_usd": round_even(units * F.col("cost"), 0)})
    # the lists of steps 4 to 10, one lookup by code
    g = g.join(list_terms(t), "code_key", "left")
    # 4: ad floor
    on_ad = F.col("ad_kind").isNotNull() & (F.length("ad_kind") > 0)
    oh_pos = F.greatest(F.col("chain_oh"), F.lit(0.0))
    ad_units = F.greatest(F.col("ad_target") * F.col("wk_vel") - oh_pos, F.lit(0.0))
    g = g.withColumn("on_ad", F.coalesce(on_ad, F.lit(False)))
    g = g.withColumn("net_buy", F.when(F.col("on_ad") & (ad_units > F.col("net_buy")), ad_units)
                     .otherwise(F.col("net_buy")))
    g = _recase(g, F.col("on_ad"))
    # 5: buy-month stock-up
    bm_wks = weeks_to_next_buy_month(F.col("buy_months"), F.lit(cur_month))
    g = g.withColumns({"bm_wks": bm_wks, "bm_stock": bm_wks > 0})
    bm_units = F.greatest(F.col("bm_wks") * F.col("wk_vel") - oh_pos, F.lit(0.0))
    g = g.withColumn("net_buy", F.when(F.col("bm_stock") & (bm_units > F.col("net_buy")), bm_units)
                     .otherwise(F.col("net_buy")))
    g = _recase(g, F.col("bm_stock"))
    # 6: enough stock chain-wide -> transfer instead of buying (NULL WOS is not cut)
    enough = F.coalesce(F.col("wos") >= target_weeks, F.lit(False)) & ~F.col("has_par") \
        & ~F.col("on_ad") & ~F.col("bm_stock")
    g = g.withColumns({c: F.when(enough, F.lit(z)).otherwise(F.col(c))
                       for c, z in (("net_buy", 0.0), ("buy_cases", 0.0), ("buy_units", 0), ("net_buy_usd", 0.0))})
    # 7: margin, deal terms, ad label, profit protected
    g = g.withColumn("gm_pct", F.when(F.col("retail") > 0,
                                      round_even((F.col("retail") - F.col("cost")) / F.col("retail") * 100, 0)))
    tw = F.coalesce(F.col("ad_target"), F.lit(config.DEFAULT_AD_TARGET))
    tw_txt = F.regexp_replace(tw.cast("string"), r"\.0$", "")
    tag = F.concat(F.lit("ON AD - "),
                   F.when(F.lower(F.col("ad_kind")).startswith("sun"), "Sunday").otherwise("weekly"),
                   F.lit(" special (buy to "), tw_txt, F.lit("w)"))
    deal = F.coalesce(F.col("deal"), F.lit(""))
    g = g.withColumn("deal_terms", F.when(F.col("on_ad"), F.when(deal != "", F.concat(tag, F.lit("; "), deal))
                                          .otherwise(tag)).otherwise(deal))
    g = g.withColumn("on_deal", F.length("deal_terms") > 0)
    g = g.withColumn("profit_protected", F.col("wk_vel") * F.greatest(F.coalesce(F.col("retail"), F.col("cost"))
                                                                    - F.col("cost"), F.lit(0.0)))
    # 8: bought lines, discontinued split
    discontinued = F.lower(F.coalesce(F.col("supplier"), F.lit(""))).contains("discontinued")
    buy = g.filter(F.col("buy_units") > 0).withColumn("removed", F.coalesce("on_remove", F.lit(False)) | discontinued)
    # 9: buy-month timing
    has_months = F.col("buy_months").isNotNull() & (F.size("buy_months") > 0)
    mtxt = F.array_join(F.transform(F.coalesce(F.col("buy_months"), _empty_months()), lambda m: month_abbr(m)), ", ")
    in_month = F.array_contains(F.coalesce(F.col("buy_months"), _empty_months()), F.lit(cur_month))
    lasts = F.when(F.col("bm_wks") >= 4, F.concat(F.lit(" - stock up ~"), round_even(F.col("bm_wks"), 0)
                                                   .cast("bigint").cast("string"), F.lit("wks to next deal"))) \
        .otherwise(F.lit(""))
    urgent = F.col("wos").isNotNull() & (F.col("wos") < 2)
    buy = buy.withColumn("buy_month", F.when(~has_months, F.lit(""))
                         .when(in_month, F.concat(F.lit("In buy-month ("), mtxt, F.lit(")"), lasts))
                         .when(urgent, F.concat(F.lit("Off-month, buy anyway - urgent (deal: "), mtxt, F.lit(")")))
                         .otherwise(F.concat(F.lit("Wait for buy-month ("), mtxt, F.lit(")"))))
    buy = buy.withColumn("section", F.when(F.col("removed"), "removed")
                         .when(F.col("buy_month").startswith("Wait for"), "wait").otherwise("order"))
    # 10: review reasons
    buy = buy.withColumn("is_new", F.coalesce("is_new", F.lit(False)))
    bmn = F.col("buy_month")
    reasons = [
        F.when(~F.coalesce(F.col("cost") > 0, F.lit(False)), F.lit("No cost data - verify price")),
        F.when(F.col("gm_pct").isNull() | (F.col("gm_pct") < 0), F.lit("Margin looks off - check retail/cost"))
         .when(F.col("gm_pct") > 95, F.lit("Margin over 95% - check retail")),
        F.when(F.col("net_buy_usd") >= config.REVIEW_BUY_USD,
               F.concat(F.lit("Large buy ("), _money_text(F.col("net_buy_usd")), F.lit(") - confirm"))),
        F.when(F.col("wos").isNotNull() & (F.col("wos") > 8) & ~bmn.startswith("In buy-month"),
               F.concat(F.lit("Overstocked ("), round_even(F.col("wos"), 0).cast("bigint").cast("string"),
                        F.lit(" wks on hand) - confirm before buying more"))),
        F.when(bmn.startswith("In buy-month") & bmn.contains("stock up"),
               F.concat(F.lit("Buy-month stock-up ("), _money_text(F.col("net_buy_usd")), F.lit(" to next deal) - confirm"))),
        F.when(F.col("is_new"), F.lit("New item - set quantity by hand")),
        F.when(bmn.startswith("Off-month"), F.lit("Off buy-month - confirm timing")),
        F.when(F.col("ly_wk").isNotNull() & (F.col("ly_wk") >= 2) & (F.col("ly_wk") >= 1.5 * F.col("wk_vel")),
               F.concat(F.lit("Seasonal - last year ~"), round_even(F.col("ly_wk"), 0).cast("bigint").cast("string"),
                        F.lit("/wk vs "), round_even(F.col("wk_vel"), 0).cast("bigint").cast("string"),
                        F.lit(" now, buy ahead?"))),
    ]
    buy = (buy.withColumn("review", F.when(F.col("section") == "order", join_text(reasons)).otherwise(F.lit("")))
              .withColumn("buy_month", F.when(F.col("removed"), F.lit("")).otherwise(F.col("buy_month"))))
    # 11: buyer overrides (order lines only)
    if decisions is not None:
        orders = apply_overrides(buy.filter(F.col("section") == "order"), decisions)
        buy = orders.unionByName(buy.filter(F.col("section") != "order"))
    return buy


def _present(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "dept", "item", clean_code("code").alias("product_code"), "category", "supplier",
        F.col("chain_oh"), "wos", "trend", "ly_wk", F.col("gross_need"), F.col("transfer"),
        "buy_units", "buy_cases", round_even(F.col("cost"), 2).alias("unit_cost"), "net_buy_usd",
        "gm_pct", "discount_pct", "deal_terms", "buy_month", "review", *extra)


def weekly_order(needs: DataFrame, t, *, budget: float | None = config.WEEKLY_BUDGET,
                 priority: str = config.PRIORITY, decisions: DataFrame | None = None,
                 planned: DataFrame | None = None) -> DataFrame:
    """The order sheet(s): section order (within budget), deferred (over budget), removed, wait.
    A caller that has the item plan of ``needs`` passes it on."""
    lines = order_lines(item_plan(needs) if planned is None else planned, t, decisions=decisions)
    if budget is None:
        return _present(lines, "section")
    # the other sections run along as keys of their own, so the lines are worked out once
    ranked = running_sum(lines, ["dept", "section"], priority_order(priority) + [F.col("item")], "net_buy_usd", "cum_buy")
    ordered = F.col("section") == "order"
    ranked = ranked.withColumns({"section": F.when(ordered & ~F.coalesce(F.col("cum_buy") <= budget, F.lit(False)), "deferred").otherwise(F.col("section")),
                                 "cum_buy": F.when(ordered, F.col("cum_buy"))})
    return _present(ranked, "section", "cum_buy")


def dept_summary(needs: DataFrame, t) -> DataFrame:
    """Per department items, gross $, transfer $, net buy $, plus an all-departments
    row (``dept`` NULL) from the same rollup. Gross/transfer count every item; net counts
    the surviving order lines only."""
    planned = write_table(item_plan(needs), "item-plan")
    money = planned.groupBy("dept").agg(
        F.sum(round_even(F.col("gross_need") * F.col("cost"), 0)).alias("gross_usd"),
        F.sum(round_even(F.col("transfer") * F.col("cost"), 0)).alias("transfer_usd"))
    lines = order_lines(planned, t).filter(F.col("section") == "order")
    net = lines.groupBy("dept").agg(F.count("*").alias("items"), F.sum("net_buy_usd").alias("net_buy_usd"))
    per = money.join(net, "dept", "left").select(
        "dept", F.coalesce("items", F.lit(0)).alias("items"), "gross_usd", "transfer_usd",
        F.coalesce("net_buy_usd", F.lit(0.0)).alias("net_buy_usd"))
    return per.rollup("dept").agg(F.sum("items").alias("items"), F.sum("gross_usd").alias("gross_usd"),
                                  F.sum("transfer_usd").alias("transfer_usd"),
                                  F.sum("net_buy_usd").alias("net_buy_usd"))


# ---- registered queries -----------------------------------------------------------------

def q_weekly_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    return weekly_order(store_needs(t), t).filter(F.col("section") == "order").drop("section")


def q_needs_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    w = weekly_order(store_needs(t), t)
    return w.filter((F.col("section") == "order") & (F.length("review") > 0)).drop("section")


def q_being_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    return weekly_order(store_needs(t), t).filter(F.col("section") == "removed").drop("section")


def q_buy_month_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    return weekly_order(store_needs(t), t).filter(F.col("section") == "wait").drop("section")


def q_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W03 with a $50,000 weekly budget per department: order vs deferred by running $."""
    t = ctx(spark, sf_dir)
    w = weekly_order(store_needs(t), t, budget=50000.0)
    return w.filter(F.col("section").isin("order", "deferred")).select(
        "dept", "item", "wos", "net_buy_usd", "cum_buy", "section")


def q_weekly_order_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q02 with the buyers' decisions, written and read as JSON files (S06), applied to its order lines
    (J10)."""
    t = ctx(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), "decisions", uuid.uuid4().hex[:12])
    t.order_decisions.write.json(path)
    return (weekly_order(store_needs(t), t, decisions=read_decisions(spark, path))
            .filter(F.col("section") == "order").drop("section"))


def _ranked(priority: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = ctx(spark, sf_dir)
        w = weekly_order(store_needs(t), t, budget=50000.0, priority=priority)
        return w.filter(F.col("section").isin("order", "deferred")).select(
            "dept", "item", "net_buy_usd", "cum_buy", "section")
    query.__doc__ = f"W08 + W03: the {priority} ranking of each department's order under a $50,000 budget."
    return query


q_rank_margin, q_rank_deals, q_rank_balanced = map(_ranked, ("margin", "deals", "balanced"))


def q_dept_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    return dept_summary(store_needs(t), t)
