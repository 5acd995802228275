"""Whole folders of workbooks (S01, S04, P11-P13), and every sale day with the ad week in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..sources.folders import (choose_columns, column_profile, elect_headers, folder_tab_items, inventory_rows, price_reference,
                               price_sheets)
from ..sources.landed import ad_blocks
from .base import ctx


def q_price_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S04 + A06: the cost reference of a folder of differently laid out price workbooks."""
    return price_reference(ctx(spark, sf_dir).workbooks)


def q_book_headers(spark, sf_dir):
    """Each workbook's price sheet, its header row and the place of every field."""
    at = price_sheets(ctx(spark, sf_dir).workbooks)
    return at.select("file", "sheet", F.col("header_row").cast("bigint").alias("header_row"), "width",
                     *[F.col("at")[f].alias(f"{f}_at") for f in ["upc", "units", "deal", "netunit", "casecost", "buymonths"]])


def q_book_inventory(spark, sf_dir):
    """The rows of the inventory sheet that each workbook's scores choose."""
    return inventory_rows(ctx(spark, sf_dir).workbooks)


def q_book_tab_items(spark, sf_dir):
    """The Remove tabs of all workbooks, one row per code."""
    return folder_tab_items(ctx(spark, sf_dir).workbooks, "Remove")


def q_book_columns(spark, sf_dir):
    """P12 + P13: code and money column of every sheet with a header, from one profile."""
    rows = ctx(spark, sf_dir).workbooks
    return choose_columns(column_profile(rows, elect_headers(rows).filter("header_row IS NOT NULL")))


def ad_weeks(days: DataFrame, sheets: DataFrame, by: list[str], day: str = "day") -> DataFrame:
    """J18 for many days and sheets: every row of ``days`` with the block of its sheet that is in force - the latest ad
    date on or before the day (of two with one date the first), else the earliest."""
    heads = ad_blocks(sheets, keep=by).withColumnRenamed("row_idx", "block_row")
    return asof_join(days, heads, by, day, "ad_date", tie="block_row", else_first=True)


def _sale_days(t) -> DataFrame:
    return (t.history.groupBy(F.col("category").alias("sheet"), "day")
             .agg(F.sum("units").alias("units"), F.sum("lines").alias("lines")))


def q_ad_days(spark, sf_dir):
    """Every sale day of every category with the ad block of its sheet."""
    t = ctx(spark, sf_dir)
    return ad_weeks(_sale_days(t).select("sheet", "day"), t.ad_sheets, ["sheet"])


def q_ad_week_sales(spark, sf_dir):
    """What was sold under each ad block: days, units and lines. Days come first, then the as-of join, so it handles one row
    per sheet and day."""
    t = ctx(spark, sf_dir)
    return (ad_weeks(_sale_days(t), t.ad_sheets, ["sheet"]).groupBy("sheet", "ad_date", "block_row")
            .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"),
                 F.sum("units").cast("double").alias("units"), F.sum("lines").alias("lines")))
