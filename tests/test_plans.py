"""Plan checks on every registered query: no cartesian products or nested-loop joins, no
Python evaluation, and no window without a partition key (which would pull a whole table
into one task)."""

import pytest

from conftest import SF_SMALL
from stockroom.plans.registry import QUERIES

_KEYS = sorted(k for k in QUERIES if not k.startswith(("stream_", "ledger_")))
_FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def _nodes(node):
    yield node
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(node.inputPlan())
        return
    kids = node.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


def unpartitioned_windows(df) -> int:
    """Window operators whose partition spec is empty (they would run in one task)."""
    plan = df._jdf.queryExecution().executedPlan()
    return sum(1 for n in _nodes(plan) if n.nodeName() == "Window" and n.partitionSpec().isEmpty())


def test_detector_sees_an_unpartitioned_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    good = spark.range(10).withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert unpartitioned_windows(bad) == 1 and unpartitioned_windows(good) == 0


@pytest.fixture
def materialised(monkeypatch):
    """The frames a query writes or checkpoints on the way (its final plan starts after them). The
    domain views, which stand for stored tables, are left out."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter
    seen = []
    write, checkpoint = DataFrameWriter.parquet, DataFrame.checkpoint

    def parquet(self, path, *args, **kwargs):
        if "/view-" not in path:
            seen.append(self._df)
        return write(self, path, *args, **kwargs)

    def cut(self, *args, **kwargs):
        seen.append(self)
        return checkpoint(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(DataFrame, "checkpoint", cut)
    return seen


@pytest.mark.parametrize("key", _KEYS)
def test_plan_shape(spark, materialised, key):
    for df in [QUERIES[key](spark, SF_SMALL), *materialised]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in _FORBIDDEN:
            assert bad not in plan, f"{key}: {bad} in plan"
        assert unpartitioned_windows(df) == 0, f"{key}: window without partition key"


@pytest.mark.parametrize("key", ["vendor_order", "headline_kpis", "dept_summary", "store_vendor_rollup", "store_receiving_rollup"])
def test_no_sort_below_an_aggregate_and_one_allocation(spark, materialised, key):
    frames = [QUERIES[key](spark, SF_SMALL), *materialised]
    folds = sum(df._jdf.queryExecution().optimizedPlan().toString().count("_moves") > 0 for df in frames)
    assert folds <= 2  # the plan that allocates, and at most one that reads its moves
    for df in frames:
        text = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        sorts = [k for k, line in enumerate(text) if line.strip(" +-:").startswith("Sort [")]
        assert all(k == 0 for k in sorts), f"{key}: sorted below the result"


def test_history_in_steps_equals_its_text(spark):
    """The history view built in steps has the rows of its text, with parts that come twice, nulls and parts without lines."""
    import datetime
    from stockroom.sources.fixtures import VIEWS
    from stockroom.sources.tables import PLANS
    at = datetime.datetime
    lines = spark.createDataFrame([(1, at(2024, 1, 1, 3), 2.0), (1, at(2024, 1, 1, 9), 3.0), (1, None, 1.0), (2, at(2024, 1, 2), None),
                                   (None, at(2024, 1, 2), 4.0), (9, at(2024, 1, 2), 4.0)], "l_partkey bigint, l_shipdate timestamp, l_quantity double")
    part = spark.createDataFrame([(1, "b", "zinc"), (1, "b", "ale"), (1, "c", None), (2, None, "gear"), (3, "d", "x")], "p_partkey bigint, p_brand string, p_name string")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    got = PLANS["history"](lineitem=lines, part=part)
    assert rows(got) == rows(spark.sql(VIEWS["history"], lineitem=lines, part=part))


def test_item_index_needs_no_window_and_tasks_follow_rows(spark, monkeypatch):
    from stockroom.operators import history as H
    days = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2023-12-31')) AS day")
    h = H.src_history(days.crossJoin(spark.range(40)).selectExpr("day", "cast(id AS string) AS code", "'c' AS category", "'i' AS item", "month(day) * 1.0D AS units"))
    monkeypatch.setattr(H, "ROWS_PER_TASK", 100)
    index = H.item_month_rows(h)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "REPARTITION_BY_NUM" in plan  # 480 cube rows: 5 tasks
    assert index.count() == 480 and H.item_seasonality(h).filter("peak_month = 'Dec' AND item = 'i'").count() == 40


def test_inventory_in_steps_equals_its_text(spark):
    """The inventory view over dealt-out lines has the rows of its text, with parts that come twice, nulls and lost suppliers."""
    import datetime
    from stockroom.sources.fixtures import VIEWS
    from stockroom.sources.tables import PLANS
    day = datetime.datetime(2001, 6, 10)
    frames = {
        "lineitem": spark.createDataFrame([(1, 1, day, 2.0), (1, 2, day, 3.0), (1, 1, None, 1.0), (2, 1, day, None), (None, 1, day, 4.0), (9, 1, day, 4.0), (2, 7, day, 1.0)],
                                          "l_partkey bigint, l_suppkey bigint, l_shipdate timestamp, l_quantity double"),
        "supplier": spark.createDataFrame([(1, "s1", 3), (2, "s0", 3), (2, "s2", 4), (3, None, 5)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "nation": spark.createDataFrame([(3, "N3"), (4, "N4")], "n_nationkey int, n_name string"),
        "part": spark.createDataFrame([(1, "b", "zinc", "small", 400.0), (1, "b", "ale", "small", 410.0), (2, None, "gear", "large", None)],
                                      "p_partkey bigint, p_brand string, p_name string, p_type string, p_retailprice double")}
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    got = PLANS["inventory"](**frames)
    assert rows(got) == rows(spark.sql(VIEWS["inventory"], **frames)) and "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["restock_brief", "needs_attention_stockouts"])
def test_tasks_of_the_brief_follow_rows(spark, monkeypatch, materialised, key):
    """Each join and aggregate of the snapshot's rows, and the monthly cube, is dealt out by row count."""
    from stockroom.operators import history as H
    from stockroom.sources.tables import forget
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    whole = QUERIES[key](spark, SF_SMALL)
    before = rows(whole)
    monkeypatch.setattr(H, "ROWS_PER_TASK", 300)
    forget(spark, SF_SMALL)
    del materialised[:]
    got = QUERIES[key](spark, SF_SMALL)
    dealt = lambda df: df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")
    assert dealt(got) >= 7 and any("first_day" in df.columns and dealt(df) for df in materialised)
    assert rows(got) == before
    if key == "restock_brief":
        top = [r["wk_usd_at_risk"] for r in got.collect()]
        assert got.rdd.getNumPartitions() > 1 and top == sorted(top, reverse=True)
    forget(spark, SF_SMALL)
