"""Daily buying brief queries: restock actions (Q06/W02), pricing flags (Q07), deal
evaluation (Q10), inventory snapshot (Q05/A02), chain rollup by code (A04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.codes import norm_code
from ..functions.numeric import round_even, trend_label
from ..operators.clean import dept_scope, drop_nonretail, src_inventory
from ..operators.history import by_key, src_history, tasks_for
from ..operators.joins import buyer_terms, last_rows
from ..operators.rollups import chain_by_code, first_by
from .base import ctx
from .history import seasonal_factors
from ..session import write_table

def _brief_rows(t, *, retail_only: bool = True, departments=None) -> DataFrame:
    """Snapshot rows of the brief's departments (value *contains* match, as the brief does), labelled
    by ``dept``. Default: every department; a single-department brief passes its own."""
    inv = src_inventory(t.inventory)
    if retail_only:
        inv = drop_nonretail(inv)
    return dept_scope(inv, departments or config.FIXTURE_DEPARTMENTS, contains=True)


def brief_factors(t) -> tuple[DataFrame, DataFrame]:
    """Item and category seasonal factors (Q09) as the brief reads them: the nightly
    history insights, written once per session to the shared checkpoint folder (the
    original brief likewise reads the factors the history step wrote)."""
    def build(x):
        item_f, cat_f = seasonal_factors(x.derived("history", lambda y: src_history(y.history)))
        return write_table(item_f, "item-factors"), write_table(cat_f, "category-factors")
    return t.derived("brief-factors", build)


def season_factor(df: DataFrame, t, rows: int) -> DataFrame:
    """Item factor by code, else category factor, else 1.0; records which applied. ``rows``: about how many ``df`` has."""
    item_f, cat_f = brief_factors(t)
    i = by_key(item_f.select(F.col("code").alias("_ic"), F.col("factor").alias("_if")), "_ic", rows)
    c = cat_f.select(F.col("category").alias("_cc"), F.col("factor").alias("_cf"))
    df = by_key(df.withColumn("_nc", norm_code("code")), "_nc", rows)
    j = (df.join(i, df["_nc"] == i["_ic"], "left")
           .join(c, F.trim(df["category"]) == c["_cc"], "left"))
    return (j.withColumn("season_f", F.coalesce("_if", "_cf", F.lit(1.0)))
             .withColumn("season_src", F.when(F.col("_if").isNotNull(), "item").otherwise("category"))
             .drop("_nc", "_ic", "_if", "_cc", "_cf"))


_SRC = T.ArrayType(T.StructType([T.StructField("store", T.StringType()), T.StructField("qty", T.DoubleType())]))
_POOL = T.ArrayType(T.StructType([T.StructField("ns", T.DoubleType()), T.StructField("store", T.StringType())]))


def _walk(short: Column, pool: Column) -> Column:
    """W02 fold: receivers in velocity order drain donors largest-remaining-first, no
    minimum move; returns per receiver (store, got, src)."""
    move_t = T.StructType([T.StructField("row", T.LongType()), T.StructField("got", T.DoubleType()),
                           T.StructField("src", _SRC)])
    zero = F.struct(pool.alias("pool"), F.array().cast(T.ArrayType(move_t)).alias("moves"))

    def receive(acc, r):
        z = F.struct(F.array().cast(_POOL).alias("pool"), r["need"].alias("need"),
                     F.lit(0.0).alias("got"), F.array().cast(_SRC).alias("src"))

        def give(a, d):
            avail = -d["ns"]
            take = F.least(a["need"], avail)
            ok = (a["need"] > 0) & (take > 0)
            kept = F.when(avail - take > 0, F.concat(a["pool"], F.array(F.struct((take - avail).alias("ns"),
                                                                                  d["store"].alias("store"))))) \
                .otherwise(a["pool"])
            return F.when(ok, F.struct(kept.alias("pool"), (a["need"] - take).alias("need"),
                                       (a["got"] + take).alias("got"),
                                       F.concat(a["src"], F.array(F.struct(d["store"].alias("store"),
                                                                           take.alias("qty")))).alias("src"))) \
                .otherwise(F.struct(F.concat(a["pool"], F.array(d)).alias("pool"), a["need"].alias("need"),
                                    a["got"].alias("got"), a["src"].alias("src")))

        def finish(a):
            mv = F.struct(r["row"].cast("long").alias("row"), a["got"].alias("got"), a["src"].alias("src"))
            return F.struct(a["pool"].alias("pool"), F.concat(acc["moves"], F.array(mv)).alias("moves"))

        return F.aggregate(F.array_sort(acc["pool"]), z, give, finish)

    return F.aggregate(short, zero, receive, lambda acc: acc["moves"])


def restock_actions(t, *, target_weeks: float = config.BRIEF_TARGET_WEEKS) -> DataFrame:
    """Per store restock line - transfer from surplus stores first, buy the rest. Every step deals its rows
    out by their count: snapshot rows pack so well that shares cut by stored size grow far larger in memory."""
    n_rows = t.inventory.count()
    df = _brief_rows(t).dropna(subset=["item"])
    v30, v90 = F.col("u30") * 7 / 30, F.col("u90") * 7 / 90
    df = (df.withColumn("vel", F.lit(config.BLEND_30) * v30 + F.lit(config.BLEND_90) * v90)
            .withColumn("trend_r", F.when(v90 > 0, v30 / v90).otherwise(F.lit(1.0))))
    df = season_factor(df, t, n_rows)
    df = (df.withColumn("target", F.ceil(F.col("vel") * target_weeks * F.col("season_f")).cast("double"))
            .withColumn("ohp", F.greatest(F.col("on_hand"), F.lit(0.0)))
            .withColumn("need", F.greatest(F.col("target") - F.col("ohp"), F.lit(0.0)))
            .withColumn("surp", F.greatest(F.col("ohp") - F.col("target"), F.lit(0.0))))
    per_item = by_key(df, ["dept", "item"], n_rows).groupBy("dept", "item").agg(
        F.median("price_raw").alias("item_price"),
        first_by("code").alias("item_code"),
        F.array_sort(F.collect_list(F.when(F.col("need") > 0, F.struct(
            (-F.col("vel")).alias("nv"), F.col("store").alias("store"), F.col("ingest_row").alias("row"),
            F.col("need").alias("need"))))).alias("_short"),
        F.collect_list(F.when(F.col("surp") > 0, F.struct((-F.col("surp")).alias("ns"),
                                                           F.col("store").alias("store")))).alias("_pool"))
    moves = per_item.select("item", "item_price", "item_code",
                            F.explode(_walk(F.col("_short"), F.col("_pool"))).alias("m"))
    moves = moves.select("item", "item_price", "item_code", F.col("m.row").alias("ingest_row"),
                         F.col("m.got").alias("got"), F.col("m.src").alias("src"))
    # an item may have several codes in a store: a receiver is a row, not a store
    rows = by_key(df.filter(F.col("need") > 0), "ingest_row", n_rows).join(by_key(moves.drop("item"), "ingest_row", n_rows), "ingest_row")
    rows = by_key(rows.withColumn("_ik", norm_code("item_code")), "_ik", n_rows).join(
        by_key(buyer_terms(t.deals).withColumnRenamed("code_key", "_bk"), "_bk", n_rows), F.col("_ik") == F.col("_bk"), "left")
    buy = F.greatest(F.col("need") - F.col("got"), F.lit(0.0)).cast("bigint")
    xfer = F.array_join(F.transform("src", lambda s: F.concat(s["qty"].cast("bigint").cast("string"),
                                                               F.lit(" from "), s["store"])), ", ")
    act = F.when(F.size("src") > 0, F.concat(F.lit("Transfer "), xfer)).otherwise(F.lit(""))
    act = F.when(buy > 0, F.when(act != "", F.concat(act, F.lit("; BUY "), buy.cast("string")))
                 .otherwise(F.concat(F.lit("BUY "), buy.cast("string")))).otherwise(act)
    return rows.select(
        "dept", "item", "store",
        F.when((F.col("ohp") == 0) & (F.col("vel") > 0), "STOCKOUT").otherwise("").alias("stockout"),
        F.col("on_hand").cast("bigint").alias("on_hand"),
        round_even(F.col("vel"), 1).alias("wk_velocity"),
        trend_label(F.col("trend_r")).alias("trend"),
        round_even(F.col("season_f"), 2).alias("season_x"),
        F.col("season_src").alias("season_basis"),
        F.col("need").cast("bigint").alias("need"),
        F.col("got").cast("bigint").alias("transfer_qty"),
        buy.alias("buy_qty"),
        F.when(F.col("item_price").isNotNull(), round_even(F.col("vel") * F.col("item_price"), 2)).otherwise(F.lit(0.0))
         .alias("wk_usd_at_risk"),
        "discount_pct", "buyer_gm_pct", F.coalesce("deal", F.lit("")).alias("deal_terms"),
        act.alias("action"))


def pricing_flags(t) -> DataFrame:
    """Q07: our median price vs the cheapest named competitor, else the market mean;
    ABOVE at >= +10 %, BELOW at <= -15 %, other rows dropped."""
    inv = _brief_rows(t, retail_only=False).withColumn("upc", norm_code("code"))
    ours = inv.groupBy("dept", "upc", "item").agg(F.median("price_raw").alias("our")).filter(F.col("our") > 0)
    mp = t.market_price
    market = mp.groupBy(F.col("code_key").alias("upc")).agg(F.avg("market").alias("mkt"))
    comps = last_rows(mp, ["code_key"]).select(F.col("code_key").alias("upc"), *[F.col(c) for c in config.COMPETITORS])
    j = ours.join(market, "upc", "left").join(comps, "upc", "left")
    named = [F.col(c) for c in config.COMPETITORS]
    best = F.least(*named)
    vs_named = F.array_join(F.filter(F.array(*[F.when(F.col(c) == best, F.lit(c)) for c in config.COMPETITORS]),
                                     lambda x: x.isNotNull()), "/")
    j = (j.withColumn("bench", F.coalesce(best, F.col("mkt")))
          .withColumn("vs", F.when(best.isNotNull(), vs_named).when(F.col("mkt").isNotNull(), F.lit("Market"))))
    j = j.filter(F.col("bench").isNotNull() & (F.col("bench") > 0))
    j = j.withColumn("gap", (F.col("our") - F.col("bench")) / F.col("bench") * 100)
    j = j.withColumn("flag", F.when(F.col("gap") >= config.ABOVE_FLAG, "ABOVE market (review)")
                     .when(F.col("gap") <= -config.BELOW_FLAG, "BELOW market (raise)"))
    return j.filter(F.col("flag").isNotNull()).select(
        "dept", "item", round_even(F.col("our"), 2).alias("our_price"),
        *[round_even(F.col(c), 2).alias(c) for c in config.COMPETITORS],
        round_even(F.col("mkt"), 2).alias("market_mean"), round_even(F.col("bench"), 2).alias("market_price"),
        "vs", round_even(F.col("gap"), 1).alias("gap_pct"), "flag")


def _int_text(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def deal_evaluation(t) -> DataFrame:
    """Q10: per buyer-sheet deal: savings, season-aware suggested buy, verdict ladder."""
    inv = _brief_rows(t).withColumn("code_key", norm_code("code"))
    by_upc = chain_by_code(inv).withColumnRenamed("code_key", "upc")
    d = t.deals.withColumn("upc", norm_code("code_key"))
    d = d.withColumn("uc", F.when(F.col("units_case") > 0, F.col("units_case").cast("bigint")).otherwise(F.lit(1)))
    d = d.filter(F.col("case_cost").isNotNull() & F.col("net_unit").isNotNull()
                 & (F.col("case_cost") > 0) & (F.col("net_unit") > 0))
    d = (d.withColumn("reg_cost", F.col("case_cost") / F.col("uc"))
          .withColumn("savings", F.col("reg_cost") - F.col("net_unit"))
          .filter(F.col("savings") > config.DEAL_MIN_SAVING)
          .withColumn("disc", F.col("savings") / F.col("reg_cost") * 100)
          .filter(F.col("disc") <= config.DEAL_MAX_SAVING * 100)
          .withColumn("min_units", F.when(F.col("min_cases") > 0, (F.col("min_cases") * F.col("uc")).cast("bigint"))
                      .otherwise(F.lit(0))))
    j = d.join(by_upc.select("upc", "oh", F.col("vel").alias("wk_vel")), "upc", "left")
    j = j.withColumn("oh", F.coalesce("oh", F.lit(0.0))).withColumn("wk_vel", F.coalesce("wk_vel", F.lit(0.0)))
    item_f, cat_f = brief_factors(t)
    j = (j.join(item_f.select(F.col("code").alias("upc"), F.col("factor").alias("_if")), "upc", "left")
          .join(cat_f.select(F.col("category").alias("_cat"), F.col("factor").alias("_cf")),
                F.col("category") == F.col("_cat"), "left"))
    nz = lambda c: F.when(F.col(c) != 0, F.col(c))  # noqa: E731  ("x or y" skips 0)
    j = j.withColumn("season_f", F.coalesce(nz("_if"), nz("_cf"), F.lit(1.0)))
    j = (j.withColumn("eff_vel", F.col("wk_vel") * F.col("season_f"))
          .withColumn("wos", F.when(F.col("wk_vel") > 0, round_even(F.col("oh") / F.col("wk_vel"), 1)))
          .withColumn("target_units", F.greatest(F.col("eff_vel") * config.DEAL_COVER_WEEKS - F.col("oh"), F.lit(0.0)))
          .withColumn("sugg0", (F.ceil(F.col("target_units") / F.col("uc")) * F.col("uc")).cast("bigint"))
          .withColumn("suggested", F.greatest("sugg0", "min_units"))
          .withColumn("wks_to_sell", F.when(F.col("eff_vel") > 0, round_even(F.col("suggested") / F.col("eff_vel"), 1)))
          .withColumn("margin_at", F.when(F.col("retail").isNotNull() & (F.col("retail") != 0),
                                          (F.col("retail") - F.col("net_unit")) / F.col("retail") * 100))
          .withColumn("weekly_savings", F.col("savings") * F.col("eff_vel")))
    good = F.greatest(F.col("min_units"), (F.ceil(F.col("eff_vel") * config.DEAL_COVER_WEEKS / F.col("uc"))
                                           * F.col("uc")).cast("bigint"))
    note = F.when(F.col("season_f") >= 1.1, " (rising into season)").when(F.col("season_f") <= 0.9, " (cooling)") \
        .otherwise("")
    wts = _int_text(round_even(F.col("wks_to_sell"), 0))
    verdict = (F.when(F.col("eff_vel") <= 0, F.lit("SKIP - not selling (any quantity would sit)"))
               .when(F.col("suggested") <= 0, F.concat(F.lit("WELL-STOCKED ("), F.coalesce(F.col("wos").cast("string"), F.lit("None")),
                                                        F.lit(" wks on hand) - skip the deal for now")))
               .when(F.col("disc") < config.DEAL_MARGINAL_PCT,
                     F.concat(F.lit("MARGINAL - only "), _int_text(round_even(F.col("disc"), 0)), F.lit("% off cost")))
               .when(F.coalesce(F.col("wks_to_sell"), F.lit(0.0)) > config.DEAL_CAUTION_WEEKS,
                     F.concat(F.lit("CAUTION - "), F.col("suggested").cast("string"), F.lit("u = ~"), wts,
                              F.lit(" wks (overstock); consider ~"), good.cast("string"), F.lit("u")))
               .otherwise(F.concat(F.lit("BUY ~"), F.col("suggested").cast("string"), F.lit("u ("),
                                   F.floor(F.col("suggested") / F.col("uc")).cast("string"), F.lit("cs) - sells in ~"),
                                   wts, F.lit(" wks"), note)))
    return j.select(
        F.col("code_key"), "item", "category", F.concat(F.lit("case of "), F.col("units_case").cast("string")).alias("deal"),
        round_even(F.col("reg_cost"), 2).alias("reg_cost"), round_even(F.col("net_unit"), 2).alias("deal_cost"),
        round_even(F.col("savings"), 2).alias("savings_unit"), round_even(F.col("disc"), 0).alias("disc_pct"),
        round_even(F.col("eff_vel"), 1).alias("wk_velocity"), "wos", F.col("oh").cast("bigint").alias("on_hand"),
        F.col("min_units").alias("min_buy"), F.col("suggested").alias("suggested_buy"), "wks_to_sell",
        round_even(F.col("margin_at"), 0).alias("margin_at_deal"),
        round_even(F.col("weekly_savings"), 0).alias("weekly_saved"), verdict.alias("verdict"))


def inventory_snapshot(t) -> DataFrame:
    """Per department and item - chain OH, blended velocity, WOS, cost (buyer
    cost first), retail, margin, 30/90-day units, on-hand by store (OH > 0, file order)."""
    from .base import scoped_inventory
    inv = scoped_inventory(t)
    ref = last_rows(t.deals, ["code_key"]).select(F.col("code_key").alias("_rk"), round_even(F.col("net_unit"), 2).alias("buyer_cost"),
                         F.concat(F.lit("case of "), F.col("units_case").cast("string")).alias("ref_deal"))
    g = inv.groupBy("dept", "item").agg(
        F.sum("on_hand").alias("oh"), F.sum("u30").alias("u30"), F.sum("u90").alias("u90"),
        F.min_by("code", "ingest_row").alias("code"),
        F.min_by("category", "ingest_row").alias("category"),
        F.min_by("supplier", "ingest_row").alias("supplier"),
        F.median("cost").alias("avgc"), F.median("price").alias("ret0"), F.median("club_price").alias("club0"),
        F.array_sort(F.collect_list(F.when(F.col("on_hand") > 0, F.struct(
            F.col("ingest_row").alias("r"), F.col("store").alias("s"), F.col("on_hand").alias("oh"))))).alias("_by"))
    g = g.withColumn("vel", F.lit(config.BLEND_30) * F.col("u30") * 7 / 30 + F.lit(config.BLEND_90) * F.col("u90") * 7 / 90)
    g = g.join(ref, norm_code(g["code"]) == ref["_rk"], "left")
    ucost = F.coalesce(F.col("buyer_cost"), F.when(F.col("avgc") > 0, F.col("avgc")))
    ret = F.when(F.col("ret0") > 0, F.col("ret0"))
    return g.select(
        "dept", "item", "category", "supplier",
        F.col("oh").cast("bigint").alias("chain_oh"), round_even(F.col("vel"), 1).alias("wk_velocity"),
        F.when(F.col("vel") > 0, round_even(F.col("oh") / F.col("vel"), 1)).alias("wos"),
        round_even(ucost, 2).alias("cost"), round_even(ret, 2).alias("retail"),
        F.when(F.col("club0") > 0, round_even(F.col("club0"), 2)).alias("club"),
        F.when(ret.isNotNull() & ucost.isNotNull(), round_even((ret - ucost) / ret * 100, 0).cast("bigint")).alias("margin_pct"),
        F.coalesce(F.col("ref_deal"), F.lit("")).alias("deal"),
        F.col("u30").cast("bigint").alias("units_30d"), F.col("u90").cast("bigint").alias("units_90d"),
        F.array_join(F.transform("_by", lambda x: F.concat(x["s"], F.lit(":"), x["oh"].cast("bigint").cast("string"))),
                     ";").alias("by_store_oh"))


# ---- registered queries -----------------------------------------------------------------

def q_restock_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    order = [F.col("wk_usd_at_risk").desc(), F.col("item"), F.col("store")]
    return restock_actions(t).repartitionByRange(tasks_for(t.inventory.count()), *order).sortWithinPartitions(*order)


def q_pricing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing_flags(ctx(spark, sf_dir)).orderBy(F.col("gap_pct").desc(), "item")


def q_deal_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deal_evaluation(ctx(spark, sf_dir)).orderBy(F.col("weekly_saved").desc(), "code_key")


def q_inventory_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_snapshot(ctx(spark, sf_dir))


def q_chain_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A04 over the brief's departments: per code OH / 30D / 90D, median price, first category."""
    t = ctx(spark, sf_dir)
    inv = _brief_rows(t)
    g = chain_by_code(inv)
    return g.select("code_key", "oh", "u30", "u90", round_even(F.col("price"), 4).alias("price"), "category",
                    round_even(F.col("vel"), 4).alias("vel"))
