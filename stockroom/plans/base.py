"""Inputs shared by the composite queries: the cleaned, scoped snapshot and per-store need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators.allocate import reorder_need, transfer_plan
from ..operators.clean import dept_scope, drop_nonretail, src_inventory
from ..sources.tables import Tables, tables


def ctx(spark: SparkSession, sf_dir: str) -> Tables:
    return tables(spark, sf_dir)


def scoped_inventory(t: Tables, departments=None) -> DataFrame:
    """S01 + P01 + P02: cleaned retail rows of the configured department groups."""
    return dept_scope(drop_nonretail(src_inventory(t.inventory)),
                      departments or config.FIXTURE_DEPARTMENTS)


def store_needs(t: Tables) -> DataFrame:
    """Q01 on the scoped snapshot, par floor applied."""
    return reorder_need(scoped_inventory(t), t.par_list)


def transfers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """W01 on the store needs: (items, moves)."""
    return transfer_plan(store_needs(t))
