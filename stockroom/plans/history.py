"""History insights queries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.months import month_abbr
from ..operators import history as H
from ..sources.fixtures import AS_OF
from .base import ctx

_MONTH = datetime.date.fromisoformat(AS_OF).month


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S08 over the session's history table (one frame per session, so derived reductions
    such as the monthly cube are shared by every history query)."""
    return ctx(spark, sf_dir).derived("history", lambda t: H.src_history(t.history))


def q_src_history(spark, sf_dir):
    return hist(spark, sf_dir).select("day", "code", "category", "item", "units", "y", "m", "ym")


def q_full_months(spark, sf_dir):
    return H.full_months(hist(spark, sf_dir))


def q_category_seasonality(spark, sf_dir):
    return H.category_seasonality(hist(spark, sf_dir))


def q_item_seasonality(spark, sf_dir):
    return H.item_seasonality(hist(spark, sf_dir))


def q_item_month_index(spark, sf_dir):
    return H.item_month_index(hist(spark, sf_dir))


def q_event_lift(spark, sf_dir):
    return H.event_lift(hist(spark, sf_dir))


def q_yoy_growth(spark, sf_dir):
    return H.yoy_growth(hist(spark, sf_dir))


def q_true_velocity(spark, sf_dir):
    return H.true_velocity(hist(spark, sf_dir))


def q_buy_ahead(spark, sf_dir):
    """Q08: seasonal items whose buy-ahead month is the snapshot's month."""
    s = H.item_seasonality(hist(spark, sf_dir))
    return s.filter(F.col("buy_ahead_month") == month_abbr(F.lit(_MONTH))).orderBy(F.col("annual_units").desc())


def seasonal_factors(h: DataFrame, month: int = _MONTH) -> tuple[DataFrame, DataFrame]:
    """(item factors by code, category factors by category)."""
    item = H.next_month_ratio(H.item_month_rows(h), "code", month, config.ITEM_FACTOR_CLAMP)
    cat = H.next_month_ratio(H.category_month_index(h), "category", month, config.CATEGORY_FACTOR_CLAMP)
    return item, cat


def q_seasonal_factors(spark, sf_dir):
    item, cat = seasonal_factors(hist(spark, sf_dir))
    return (item.select(F.lit("item").alias("level"), F.col("code").alias("key"), "factor")
                .unionByName(cat.select(F.lit("category").alias("level"), F.col("category").alias("key"), "factor")))
