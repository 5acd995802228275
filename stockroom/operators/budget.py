"""Budget levers on an order sheet (W05 fit-to-budget, W06 right-size).

Both are greedy walks in a fixed order that stop once a dollar gap is closed. A greedy
prefix walk is a running sum: a line is taken while the amount taken *before* it is still
short of the gap. ``running_sum`` computes that per sheet (department) with a two-level
range scan, so a department with millions of lines is never one task.

Sheet columns used: dept, item, chain_oh, wos, buy_units, buy_cases, unit_cost,
net_buy_usd, deal_terms. Blank numbers read as 0, as a spreadsheet reader does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import running_sum

# --- fixed values: right-size -----------------------------------------------------------
RIGHT_SIZE_MIN_WEEKS = 2.0  # weeks of supply a trimmed line must still cover
AD_MARK = "ON AD"           # deal text marking an advertised line (trimmed last)


def _num(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def fit_budget(sheet: DataFrame, budget: float, keys=("dept",)) -> DataFrame:
    """Whole lines to drop so each sheet's total gets within ``budget``. Lines are
    visited by weeks of supply desc, then $ desc (item name breaks ties); lines with no $
    are skipped; a line is cut while the total minus what was cut before it is still over
    budget. Returns the cut lines with the sheet total and the $ cut before each."""
    keys = list(keys)
    rows = sheet.withColumn("_w", _num("wos")).withColumn("_net", _num("net_buy_usd"))
    totals = rows.groupBy(*keys).agg(F.sum("_net").alias("sheet_total"))
    pos = rows.filter(F.col("_net") > 0)
    walk = running_sum(pos, keys, [F.col("_w").desc(), F.col("_net").desc(), F.col("item")], "_net",
                       "cut_before", exclusive=True)
    return (walk.join(totals, keys)
                .filter(F.col("sheet_total") - F.col("cut_before") > budget)
                .select(*keys, "item", "wos", "net_buy_usd", "sheet_total", "cut_before"))


def _right_size_candidates(sheet: DataFrame, min_weeks: float) -> DataFrame:
    oh, wos, bc, bu, cost = _num("chain_oh"), _num("wos"), _num("buy_cases"), _num("buy_units"), _num("unit_cost")
    cp = F.when((bu > 0) & (bc > 0), bu / bc).otherwise(F.lit(1.0))
    vel = F.when((wos > 0) & (oh > 0), oh / wos).otherwise(F.lit(0.0))
    lean = F.greatest(F.lit(0.0), F.ceil(F.greatest(F.lit(0.0), F.lit(min_weeks) * vel - oh) / cp).cast("double"))
    return (sheet.withColumn("_bc", bc).withColumn("_cp", cp).withColumn("_vel", vel)
                 .filter((F.col("_bc") >= 1) & (F.col("_vel") > 0))
                 .withColumn("lean_cases", lean)
                 .withColumn("_room", F.col("_bc") - F.col("lean_cases"))
                 .filter(F.col("_room") >= 1)
                 .withColumn("_percase", F.col("_cp") * cost)
                 .withColumn("on_ad", F.upper(F.coalesce(F.col("deal_terms"), F.lit(""))).contains(AD_MARK))
                 .withColumn("max_freed", F.col("_room") * F.col("_percase")))


def right_size_candidates(sheet: DataFrame, min_weeks: float = RIGHT_SIZE_MIN_WEEKS) -> DataFrame:
    """W06 without a budget: every line that could drop at least one case and still cover
    ``min_weeks`` of (on-hand / WOS) velocity; out-of-stock lines are never trimmed."""
    c = _right_size_candidates(sheet, min_weeks)
    return c.select("dept", "item", "wos", "buy_cases", "lean_cases", "max_freed", "on_ad")


def right_size(sheet: DataFrame, budget: float, min_weeks: float = RIGHT_SIZE_MIN_WEEKS,
               keys=("dept",)) -> DataFrame:
    """W06 with a budget: trim cases (never below the lean count) until the sheet's $ gap
    over budget is closed - non-ad lines first, most weeks of supply first, dearest case
    first. Every line before the last one is trimmed to its lean count, so the $ freed
    before a line is the running sum of full trims."""
    keys = list(keys)
    line = _num("buy_units") * _num("unit_cost")
    gap = (sheet.groupBy(*keys).agg(F.sum(line).alias("_total"))
                .withColumn("gap", F.col("_total") - F.lit(budget)).filter(F.col("gap") > 0).drop("_total"))
    c = _right_size_candidates(sheet, min_weeks).withColumn("_full", F.col("_room") * F.col("_percase"))
    walk = running_sum(c, keys, [F.col("on_ad").asc(), _num("wos").desc(), F.col("_percase").desc(), F.col("item")],
                       "_full", "freed_before", exclusive=True)
    walk = walk.join(gap, keys).filter(F.col("freed_before") < F.col("gap"))
    trim = F.when(F.col("_percase") > 0,
                  F.least(F.col("_room"), F.ceil((F.col("gap") - F.col("freed_before")) / F.col("_percase")).cast("double"))) \
        .otherwise(F.col("_room"))
    return (walk.withColumn("trim_cases", trim)
                .select(*keys, "item", "wos", "buy_cases", (F.col("_bc") - F.col("trim_cases")).alias("new_cases"),
                        (F.col("trim_cases") * F.col("_percase")).alias("saved"), "on_ad"))
