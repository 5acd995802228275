"""Store-level need and the inter-store transfer plan.

Scale notes. Every allocation is *per item*: rows are grouped by (dept, item) once, so the
shuffle is keyed by item and a group holds at most one row per store (a snapshot has one
row per product x location). The allocation itself is a fold over that small array with
Spark's ``aggregate`` higher-order function, evaluated in the JVM - no Python worker, no
driver round trip, no per-item loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.numeric import round_even
from .joins import last_rows


def weekly_velocity(u30: str = "u30") -> F.Column:
    """30-day weekly velocity: units sold in 30 days x 7 / 30."""
    return F.col(u30) * 7 / 30


def blended_velocity(u30: str = "u30", u90: str = "u90") -> F.Column:
    """Trend-aware weekly velocity: 0.6 x 30-day pace + 0.4 x 90-day pace."""
    return F.lit(config.BLEND_30) * (F.col(u30) * 7 / 30) + F.lit(config.BLEND_90) * (F.col(u90) * 7 / 90)


def par_floor(inv: DataFrame, par: DataFrame) -> DataFrame:
    """Attach par cases by (code_key, lower(trim(store))); the last list row of a key wins,
    and only positive cases count.

    Adds ``par_cases`` (0 when none) and ``has_par``."""
    p = last_rows(par.select(F.col("code_key").alias("_pk"), F.lower(F.trim(F.col("store"))).alias("_ps"),
                             F.col("cases").alias("par_cases"), "list_row"), ["_pk", "_ps"]).filter(F.col("par_cases") > 0)
    j = inv.join(p, (inv["code_key"] == p["_pk"]) & (F.lower(F.trim(inv["store"])) == p["_ps"]), "left")
    return (j.drop("_pk", "_ps")
             .withColumn("par_cases", F.coalesce(F.col("par_cases"), F.lit(0.0)))
             .withColumn("has_par", F.col("par_cases") > 0))


def reorder_need(inv: DataFrame, par: DataFrame | None = None, *,
                 target_weeks: float = config.TARGET_WEEKS) -> DataFrame:
    """Q01: per (store, item) need = max(vel x target - max(OH, 0), 0), raised to the par
    floor (par cases x case pack - max(OH, 0)). A negative on-hand counts as 0."""
    df = inv.withColumn("vel", weekly_velocity()).withColumn("oh_need", F.greatest(F.col("on_hand"), F.lit(0.0)))
    df = df.withColumn("need", F.greatest(F.col("vel") * target_weeks - F.col("oh_need"), F.lit(0.0)))
    if par is not None:
        df = par_floor(df, par)
        pack = F.when(F.col("case_pack") == 0, 1.0).otherwise(F.col("case_pack"))
        par_units = F.col("par_cases") * pack
        df = df.withColumn("need", F.greatest(F.col("need"), F.greatest(par_units - F.col("oh_need"), F.lit(0.0))))
    else:
        df = df.withColumn("par_cases", F.lit(0.0)).withColumn("has_par", F.lit(False))
    return df


_SRC = T.ArrayType(T.StructType([T.StructField("store", T.StringType()),
                                 T.StructField("qty", T.LongType())]))
_POOL = T.ArrayType(T.StructType([T.StructField("ns", T.LongType()),
                                  T.StructField("store", T.StringType())]))
_MOVE = T.StructType([T.StructField("store", T.StringType()), T.StructField("oh", T.DoubleType()),
                      T.StructField("wos", T.DoubleType()), T.StructField("need", T.LongType()),
                      T.StructField("got", T.LongType()), T.StructField("src", _SRC)])


def _allocate(short, pool, min_transfer: int):
    """Fold: receivers in (wos, store) order each walk the donor pool by remaining surplus
    desc, store asc (pool entries carry -surplus so ``array_sort`` gives that order).

    A donor gives ``least(need, avail)`` when the receiver still needs >= min_transfer, the
    donor is not the receiver and the take is >= min_transfer. Emptied donors leave the pool;
    a remainder below the minimum stays but can never be taken."""
    m = F.lit(min_transfer).cast("long")
    zero_outer = F.struct(pool.alias("pool"), F.array().cast(T.ArrayType(_MOVE)).alias("moves"))

    def receive(acc, r):
        zero_inner = F.struct(F.array().cast(_POOL).alias("pool"), r["need"].alias("need"),
                              F.lit(0).cast("long").alias("got"), F.array().cast(_SRC).alias("src"))

        def give(a, d):
            avail = -d["ns"]
            take = F.least(a["need"], avail)
            ok = (a["need"] >= m) & (d["store"] != r["store"]) & (take >= m)
            left = avail - take
            kept_after = F.when(left > 0, F.concat(a["pool"], F.array(F.struct((-left).alias("ns"), d["store"].alias("store"))))) \
                .otherwise(a["pool"])
            taken = F.struct(kept_after.alias("pool"), (a["need"] - take).alias("need"),
                             (a["got"] + take).alias("got"),
                             F.concat(a["src"], F.array(F.struct(d["store"].alias("store"), take.alias("qty")))).alias("src"))
            skipped = F.struct(F.concat(a["pool"], F.array(d)).alias("pool"), a["need"].alias("need"),
                               a["got"].alias("got"), a["src"].alias("src"))
            return F.when(ok, taken).otherwise(skipped)

        def finish(a):
            move = F.struct(r["store"].alias("store"), r["oh"].alias("oh"), r["wos"].alias("wos"),
                            r["need"].alias("need"), a["got"].alias("got"), a["src"].alias("src"))
            return F.struct(a["pool"].alias("pool"), F.concat(acc["moves"], F.array(move)).alias("moves"))

        return F.aggregate(F.array_sort(acc["pool"]), zero_inner, give, finish)

    return F.aggregate(short, zero_outer, receive, lambda acc: acc["moves"])


def planned_items(need_rows: DataFrame, *, keep_weeks: float = config.DONOR_KEEP_WEEKS,
                  min_transfer: int = config.MIN_TRANSFER, group_cols=("dept", "item"), extra=()) -> DataFrame:
    """Per item, cover short stores from overstocked ones before anything is bought.

    Input: one row per (group..., store) with ``on_hand``, ``vel``, ``need``. One groupBy gives group...,
    gross_need, transfer, net_buy, the moves as an array and the ``extra`` aggregates of the item.
    """
    g = list(group_cols)
    d = (need_rows
         .withColumn("_surplus", F.greatest(round_even(F.col("on_hand") - F.col("vel") * keep_weeks, 0),
                                            F.lit(0.0)).cast("long"))
         .withColumn("_need", F.greatest(round_even(F.col("need"), 0), F.lit(0.0)).cast("long"))
         .withColumn("_wos", F.when(F.col("vel") > 0, F.col("on_hand") / F.col("vel")).otherwise(F.lit(1e9))))
    d = d.dropna(subset=g)  # rows without an item name are no item
    per_item = d.groupBy(*g).agg(
        F.sum("_need").alias("gross_need"),
        F.array_sort(F.collect_list(F.when(F.col("_need") > 0, F.struct(
            F.col("_wos").alias("wos"), F.col("store").alias("store"), F.col("_need").alias("need"),
            F.col("on_hand").alias("oh"))))).alias("_short"),
        F.collect_list(F.when(F.col("_surplus") >= min_transfer, F.struct(
            (-F.col("_surplus")).alias("ns"), F.col("store").alias("store")))).alias("_pool"), *extra)
    planned = per_item.withColumn("_moves", _allocate(F.col("_short"), F.col("_pool"), min_transfer)).drop("_short", "_pool")
    return (planned.withColumn("transfer", F.aggregate("_moves", F.lit(0).cast("long"), lambda a, mv: a + mv["got"]))
                   .withColumn("net_buy", F.col("gross_need") - F.col("transfer")))


def transfer_plan(need_rows: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """W01 as (items, moves):
      items: group..., gross_need, transfer, net_buy          (every item)
      moves: group..., priority, to_store, to_oh, to_wos, transfer_in, from_stores, then_buy
    """
    g = list(options.get("group_cols", ("dept", "item")))
    planned = planned_items(need_rows, **options)
    return planned.select(*g, "gross_need", "transfer", "net_buy"), planned_moves(planned, g)


def planned_moves(planned: DataFrame, g=("dept", "item")) -> DataFrame:
    """The moves of planned items, one row each."""
    mv = planned.select(*g, F.explode("_moves").alias("m")).filter(F.col("m.got") > 0)
    return mv.select(
        *g,
        F.when(F.col("m.oh") <= 0, "STOCKOUT").when(F.col("m.wos") < 2, "Low <2wk").otherwise("Top-up").alias("priority"),
        F.col("m.store").alias("to_store"),
        F.col("m.oh").cast("long").alias("to_oh"),
        round_even(F.least(F.col("m.wos"), F.lit(99.0)), 1).alias("to_wos"),
        F.col("m.got").alias("transfer_in"),
        F.array_join(F.transform("m.src", lambda s: F.concat(s["store"], F.lit(" ("), s["qty"].cast("string"), F.lit(")"))),
                     ", ").alias("from_stores"),
        (F.col("m.need") - F.col("m.got")).alias("then_buy"))


def rank_moves(moves: DataFrame, item_cost: DataFrame, ordered: bool = True) -> DataFrame:
    """Moves valued at the item's median cost, ordered by priority class then value
    (``ordered=False`` for a caller that goes on to aggregate)."""
    rank = F.create_map(*[x for k, v in config.MOVE_PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    out = (moves.join(item_cost, on=["dept", "item"], how="left")
                .withColumn("value", round_even(F.col("transfer_in") * F.col("cost"), 0))
                .withColumn("priority_rank", F.coalesce(F.element_at(rank, F.col("priority")), F.lit(3)))
                .drop("cost"))
    return out if not ordered else out.orderBy(F.col("priority_rank"), F.col("value").desc_nulls_last(), F.col("to_store"), F.col("item"))
