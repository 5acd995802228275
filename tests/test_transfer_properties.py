"""Invariants of the transfer allocator (W01) on the real snapshot."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from stockroom.plans.base import ctx, store_needs
from stockroom.operators.allocate import transfer_plan


def test_transfer_invariants(spark):
    t = ctx(spark, SF_CHECK)
    needs = store_needs(t)
    items, moves = transfer_plan(needs)
    m = moves.toPandas()
    assert len(m) > 0
    assert (m.transfer_in >= 4).all()                       # minimum move
    assert (m.then_buy >= 0).all()                          # never more than the need
    for _, r in m.iterrows():                              # no self-donation, each leg >= 4
        for part in r.from_stores.split(", "):
            store, qty = part.rsplit(" (", 1)
            assert store != r.to_store and int(qty[:-1]) >= 4
    it = items.toPandas()
    assert (it.net_buy == it.gross_need - it.transfer).all()
    assert it.transfer.sum() == m.transfer_in.sum()


def test_donors_never_exceed_surplus(spark):
    t = ctx(spark, SF_CHECK)
    needs = store_needs(t)
    _, moves = transfer_plan(needs)
    legs = (moves.select("dept", "item", F.explode(F.split("from_stores", ", ")).alias("leg"))
                 .select("dept", "item", F.regexp_extract("leg", r"^(.*) \((\d+)\)$", 1).alias("store"),
                         F.regexp_extract("leg", r"^(.*) \((\d+)\)$", 2).cast("long").alias("qty")))
    given = legs.groupBy("dept", "item", "store").agg(F.sum("qty").alias("given"))
    surplus = needs.select("dept", "item", "store",
                           F.greatest(F.bround(F.col("on_hand") - F.col("vel") * 4, 0), F.lit(0.0)).alias("surplus"))
    bad = given.join(surplus, ["dept", "item", "store"]).filter(F.col("given") > F.col("surplus")).count()
    assert bad == 0


def test_input_order_does_not_matter(spark):
    t = ctx(spark, SF_CHECK)
    needs = store_needs(t)
    a = sorted(map(tuple, transfer_plan(needs)[1].toPandas().values.tolist()))
    b = sorted(map(tuple, transfer_plan(needs.repartition(7).orderBy(F.rand(3)))[1].toPandas().values.tolist()))
    assert a == b
