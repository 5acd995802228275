"""Ingest cleaning and scoping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.codes import norm_code
from ..functions.numeric import num_or_zero

INVENTORY_NUMERIC = ["on_hand", "u30", "u90", "u_ly4", "case_pack", "avg_cost", "supplier_cost",
                     "purchase_price", "price"]


def with_optional(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add missing optional columns as typed NULLs so later code never tests for presence."""
    for n, t in names.items():
        if n not in df.columns:
            df = df.withColumn(n, F.lit(None).cast(t))
    return df


def cost_cascade(*cols: str) -> Column:
    """First positive of the cost columns in order, else the last one's value (0 when missing)."""
    out = F.lit(0.0)
    for c in cols:
        out = F.when(out > 0, out).otherwise(F.coalesce(F.col(c), F.lit(0.0)))
    return out


def src_inventory(raw: DataFrame) -> DataFrame:
    """Canonical store-level snapshot. Numbers coerced (bad -> 0), cost cascade
    avg -> supplier -> purchase, code key normalised."""
    df = with_optional(raw, {"purchase_price": "double", "u_ly4": "double", "club_price": "double",
                             "ingest_row": "bigint", "code_key": "string"})
    df = df.withColumn("price_raw", F.col("price").cast("string").try_cast("double"))
    for c in INVENTORY_NUMERIC:
        df = df.withColumn(c, num_or_zero(c))
    return (df.withColumn("code_key", F.coalesce(F.col("code_key"), norm_code("code")))
              .withColumn("cost", cost_cascade("avg_cost", "supplier_cost", "purchase_price")))


def drop_nonretail(df: DataFrame, locations=None, store_col: str = "store") -> DataFrame:
    """Remove non-store locations (exact match after trim)."""
    locs = list(locations if locations is not None else config.NON_RETAIL_LOCATIONS)
    if not locs:
        return df
    return df.filter(~F.trim(F.col(store_col)).isin(locs))


def dept_label(departments=None, col: str = "department", contains: bool = False) -> Column:
    """Department group label. Exact lower-cased match by default; with ``contains`` a
    value matches a group when it contains one of the group's values. NULL = out of scope."""
    groups = departments or config.DEPARTMENTS
    v = F.lower(F.trim(F.coalesce(F.col(col), F.lit(""))))
    out = None
    for label, values in groups.items():
        cond = None
        for x in values:
            c = v.contains(x) if contains else (v == x)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def dept_scope(df: DataFrame, departments=None, col: str = "department",
               contains: bool = False) -> DataFrame:
    """Keep rows of the configured department groups, labelled in ``dept``."""
    return (df.withColumn("dept", dept_label(departments, col, contains))
              .filter(F.col("dept").isNotNull()))


def category_report(df: DataFrame, department: str, exclude_categories=(),
                    exclude_location: str | None = None) -> DataFrame:
    """One department minus excluded categories and one location, sorted by store, item."""
    out = df.filter(F.lower(F.trim(F.col("department"))) == department.lower())
    if exclude_categories:
        out = out.filter(~F.lower(F.trim(F.col("category"))).isin([c.lower() for c in exclude_categories]))
    if exclude_location:
        out = out.filter(F.trim(F.col("store")) != exclude_location)
    return out.orderBy("store", "item")


# --- P09 row tests ------------------------------------------------------------------------

def _leading_number(c: Column) -> Column:
    """A spreadsheet reader's number of a cell: the leading numeric part of its text
    (``12 cs`` -> 12), NULL when there is none."""
    s = F.regexp_extract(F.trim(c.cast("string")), r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", 0)
    return F.when(s != "", s.try_cast("double"))


def row_test(column: str, test: str, value=None) -> Column:
    """Predicate of one cell test - zero, negative, blank, equals, contains (case-
    insensitive), greaterthan, lessthan. Numeric tests read the cell's leading number; a
    non-numeric cell never passes them. Unknown tests match nothing."""
    cell = F.col(column)
    num = _leading_number(cell)
    text = F.coalesce(cell.cast("string"), F.lit(""))
    t = str(test or "").lower()
    if t == "zero":
        p = num == 0
    elif t == "negative":
        p = num < 0
    elif t == "blank":
        p = cell.isNull() | (text == "")
    elif t == "equals":
        p = text == F.lit("" if value is None else str(value))
    elif t == "contains":
        p = F.instr(F.lower(text), F.lit(str(value or "").lower())) > 0
    elif t == "greaterthan":
        p = num > F.lit(float(value))
    elif t == "lessthan":
        p = num < F.lit(float(value))
    else:
        p = F.lit(False)
    return F.coalesce(p, F.lit(False))


def delete_rows_where(df: DataFrame, column: str, test: str, value=None) -> DataFrame:
    return df.filter(~row_test(column, test, value))


def flag_rows_where(df: DataFrame, flag: str, column: str, test: str, value=None) -> DataFrame:
    return df.withColumn(flag, row_test(column, test, value))


# --- S12 pasted purchase-order block -> import file -----------------------------------------

# fixed values: the import file's columns, in order
PO_IMPORT_COLUMNS = ["CasePrice", "CaseQuantity", "CasesOrdered", "Date", "Location", "ProductCode",
                     "ReorderNumber", "Supplier", "Description", "Note", "ReferenceNumber"]


def po_import(lines: DataFrame, date: str | None = None, *, line_col: str = "line",
              order_col: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """Tab-separated pasted lines -> the 11-column PO import rows and the counts
    (rows, skipped). The first line is a header when its first cell is not a number (one
    row is read to decide); every row is right-padded to 11 cells; rows whose cases cell is
    0, blank or not a number are skipped; ``date`` overwrites the Date cell."""
    lines = lines.filter(F.trim(F.regexp_replace(F.col(line_col), "\r", "")) != "")
    first = lines.orderBy(order_col).select(order_col, line_col).first()
    if first is not None:
        head = F.trim(F.regexp_replace(F.regexp_replace(F.split(F.lit(first[1]), "\t").getItem(0), r"\$", ""), ",", ""))
        is_num = lines.sparkSession.range(1).select(head.try_cast("double").isNotNull()).first()[0]
        if not is_num:
            lines = lines.filter(F.col(order_col) != F.lit(first[0]))
    cells = F.split(F.regexp_replace(F.col(line_col), "\r", ""), "\t")
    row = lines.select(order_col, *[F.coalesce(F.get(cells, i), F.lit("")).alias(c)
                                    for i, c in enumerate(PO_IMPORT_COLUMNS)])
    cases = F.trim(F.regexp_replace(F.col("CasesOrdered"), ",", ""))
    cases_num = F.when(cases == "", F.lit(0.0)).otherwise(cases.try_cast("double"))
    row = row.withColumn("_skip", cases_num.isNull() | (cases_num == 0))
    if date:
        row = row.withColumn("Date", F.lit(date))
    counts = row.agg(F.count_if(~F.col("_skip")).alias("rows"), F.count_if(F.col("_skip")).alias("skipped"))
    return row.filter(~F.col("_skip")).drop("_skip"), counts
