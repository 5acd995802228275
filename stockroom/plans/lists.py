"""Sheet-level list operations: department category report (P05), row tests on an order
sheet (P09), pasted PO block import (S12) and the per-field price reference (A06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import category_report, delete_rows_where, flag_rows_where, po_import
from ..operators.rollups import coalesce_by_code
from .base import ctx
from .order import store_orders

# fixed values: the category report's scope (the fixture's wine department and its cuts)
REPORT_DEPARTMENT = "medium"
REPORT_EXCLUDED_CATEGORIES = ["Brand#1", "Brand#2"]
REPORT_EXCLUDED_LOCATION = "NATION_0"
IMPORT_DATE = "2001-07-02"  # the Monday stamped on every imported line


def q_category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_report(ctx(spark, sf_dir).inventory, REPORT_DEPARTMENT, REPORT_EXCLUDED_CATEGORIES,
                           REPORT_EXCLUDED_LOCATION)


def row_flags(sheet: DataFrame) -> DataFrame:
    """The four quick actions on a store order sheet: clear non-orders (cases 0 or blank),
    flag overstock (WOS > 8), flag discontinued suppliers, flag negative on-hand."""
    out = delete_rows_where(sheet, "order_cases", "zero")
    out = delete_rows_where(out, "order_cases", "blank")
    out = flag_rows_where(out, "overstock", "wos", "greaterthan", 8)
    out = flag_rows_where(out, "discontinued", "supplier", "contains", "Discontinued")
    return flag_rows_where(out, "negative_oh", "store_oh", "negative")


def q_row_flags(spark, sf_dir):
    return row_flags(store_orders(ctx(spark, sf_dir)))


def q_po_import(spark, sf_dir):
    return po_import(ctx(spark, sf_dir).po_paste, IMPORT_DATE)[0]


def q_po_import_summary(spark, sf_dir):
    return po_import(ctx(spark, sf_dir).po_paste, IMPORT_DATE)[1]


def q_cost_reference(spark, sf_dir):
    """Per code, the first non-empty value of every field across its repeated rows."""
    rows = ctx(spark, sf_dir).cost_reference_rows
    return coalesce_by_code(rows, "code_key", ["department", "buyer_cost", "deal", "buy_months"])


def q_ad_week_items(spark, sf_dir):
    """The ad week in force on the run date and its item lines."""
    import datetime
    from ..sources.fixtures import AS_OF
    from ..sources.landed import ad_week_items
    return ad_week_items(ctx(spark, sf_dir).ad_sheet, datetime.date.fromisoformat(AS_OF))


def q_report_items(spark, sf_dir):
    """Landed report pages flattened to sale items."""
    from ..sources.landed import report_items
    return report_items(ctx(spark, sf_dir).report_pages)


def q_report_lines(spark, sf_dir):
    """Whole paged reports read to their end."""
    from ..sources.landed import report_lines
    return report_lines(ctx(spark, sf_dir).report_pulls)


def q_ad_sheet_blocks(spark, sf_dir):
    """Every ad-sheet row with its block's header row and ad date."""
    from ..sources.landed import ad_blocks, carry_forward_block
    sheet = ctx(spark, sf_dir).ad_sheet
    return carry_forward_block(sheet, ad_blocks(sheet)).select("row_idx", "c2", "block_row", "ad_date")
