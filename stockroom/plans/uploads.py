"""Files as people send them, end to end: uploaded price sheets, the buyer master, list tabs, report
folders, and sheets written and read back (S03, S07, S11, S13, P08, P10-P13, T04)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import norm_code
from ..functions.months import parse_months_stem
from ..functions.numeric import loose_num, money_or_zero, num_or_zero
from ..operators.joins import buyer_terms
from ..operators.rollups import tab_items
from ..session import checkpoint_dir
from ..sources.fixtures import AS_OF
from ..sources.landed import buyer_master, report_files, write_sheet
from ..sources.sheets import cell_cols, detect_columns, detect_money_column, sheet_body, tidy_columns
from ..streaming.snapshot import newest_copy
from .base import ctx
from .brief import inventory_snapshot
from .explore import explore_filters, with_dims
from .matching import sheet_compare
from .order import store_orders


def read_upload(sheet: DataFrame) -> DataFrame:
    """S13 + P12 + P03: the code, description and price columns of an uploaded sheet as the compare
    step takes them."""
    headers, body = sheet_body(sheet)
    at, cells = detect_columns(headers, body), cell_cols(sheet)
    cell = lambda field: F.lit(None).cast("string") if at[field] is None else F.col(cells[at[field]])
    return body.select(F.coalesce(cell("upc"), F.lit("")).alias("up_code"), cell("desc").alias("up_item"),
                       loose_num(cell("price")).alias("up_price"), F.col("row_idx").alias("up_row"))


def q_upload_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 from the uploaded sheet itself."""
    t = ctx(spark, sf_dir)
    return sheet_compare(read_upload(t.upload_sheet), t.catalog, inventory_snapshot(t))


def q_buyer_master(spark, sf_dir):
    """S03 + F05a: the buyer master by column position, with the months its deal text names."""
    rows = buyer_master(ctx(spark, sf_dir).buyer_sheet)
    return rows.select("row_idx", norm_code("code").alias("code"), "description", "category",
                       num_or_zero("units_case").alias("units_case"), money_or_zero("net_unit").alias("net_unit"),
                       money_or_zero("retail").alias("retail"),
                       F.array_join(F.transform(parse_months_stem("deal"), lambda m: m.cast("string")), "|").alias("months"))


def q_upload_money(spark, sf_dir):
    """The order-dollar column of the uploaded sheet with a total column, its name and its sum."""
    sheet = ctx(spark, sf_dir).upload_sheet
    price = F.regexp_replace("c2", r"[^0-9.]", "").try_cast("double")
    sheet = sheet.withColumn("c3", F.when(F.col("row_idx") == 2, "Line Amount").when(
        F.col("row_idx") > 2, F.concat(F.lit("$"), (price * 4).cast("decimal(12,2)").cast("string"))))
    headers, body = sheet_body(sheet)
    at, guessed = detect_money_column(headers, body)
    value = F.regexp_replace(cell_cols(body)[at], r"[$,]", "").try_cast("double")
    return body.agg(F.count("*").alias("rows"), F.sum(value).alias("total")).select(
        F.lit(headers[at]).alias("header"), F.lit(guessed).alias("guessed"), "rows", "total")


def q_tidy_tab(spark, sf_dir):
    """P10: a list tab with a repeated header block, a helper column and an empty one, tidied."""
    tab = ctx(spark, sf_dir).explore_tab.select(
        F.col("row_id").alias("row_idx"), F.col("category").alias("helper key"), F.col("upc"), F.lit("").alias("Notes"),
        "description", "retail", F.col("retail").alias("retail (1)"), F.col("supplier").alias("Distributor"))
    return tidy_columns(tab, key="upc", drop_like=["helper"], preferred=["distrib", "descr"])


def q_tab_items(spark, sf_dir):
    """P11 over the list tab."""
    return tab_items(ctx(spark, sf_dir).explore_tab, "upc", "description", "row_id")


def q_report_files(spark, sf_dir):
    """S07 + F12: one report file per data date, the better folder first, then the newest."""
    return report_files(ctx(spark, sf_dir).file_listing, "folder").select("data_date", "path", "name")


def q_newest_snapshot(spark, sf_dir):
    """Of yesterday's cached snapshot and today's file, today's, whole."""
    today = inventory_snapshot(ctx(spark, sf_dir)).select("dept", "item", "chain_oh", "wos")
    copies = (today.filter("chain_oh > 10").withColumns({"copy": F.lit("cache"), "as_of": F.date_sub(F.lit(AS_OF).cast("date"), 1)})
                   .unionByName(today.withColumns({"copy": F.lit("file"), "as_of": F.lit(AS_OF).cast("date")})))
    return newest_copy(copies).drop("copy", "as_of")


def q_explore_filtered(spark, sf_dir):
    """The snapshot's products of some brands and potencies with a discount of 10 % or more."""
    t = ctx(spark, sf_dir)
    items = with_dims(t.catalog.select("cat_row", "code_key", "item"), "item")
    terms = buyer_terms(t.deals).select("code_key", F.col("discount_pct").cast("string").alias("discount"))
    return explore_filters(items.join(terms, "code_key", "left"), brands=["green", "green gear", "blue", "red", "hot"], potencies=[5, 20],
                           min_discount=10, discount_col="discount").select("cat_row", "item", "brand", "potency", "discount")


def q_store_orders_written(spark, sf_dir):
    """The store orders written as a gzipped CSV sheet and read back."""
    orders = store_orders(ctx(spark, sf_dir))
    path = os.path.join(checkpoint_dir(spark), "sheets", f"store-orders-{uuid.uuid4().hex[:12]}")
    write_sheet(orders, path, "csv", gzip=True)
    return spark.read.option("header", True).schema(orders.schema).csv(path)
