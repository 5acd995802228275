"""Landed report files: weekly-ad workbook blocks (J18, W09) and paged JSON reports."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: header wording of an ad-week block
AD_BLOCK_MARKS = ["in-store ad", "content due"]

SALES_ITEM_SCHEMA = ("locationName string, department string, category string, productCode string, "
                     "description string, quantity double, soldPrice double, total double")


def _row_text(cols: list[str]) -> F.Column:
    return F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in cols]))


def ad_blocks(sheet: DataFrame, text_cols=("c0", "c1", "c2"), date_col: str = "c_date", keep=()) -> DataFrame:
    """The header rows of an ad sheet - (row_idx, ad date) - one per week, with the columns to ``keep``."""
    text = _row_text(list(text_cols))
    is_head = None
    for m in AD_BLOCK_MARKS:
        c = F.instr(text, F.lit(m)) > 0
        is_head = c if is_head is None else (is_head | c)
    return sheet.filter(is_head & F.col(date_col).isNotNull()).select(*keep, "row_idx", F.col(date_col).alias("ad_date"))


def ad_week_items(sheet: DataFrame, target: datetime.date, text_cols=("c0", "c1", "c2"),
                  item_col: str = "c2", type_col: str = "c1", date_col: str = "c_date") -> DataFrame:
    """Item lines of the ad week in force on ``target`` - the block with the latest date
    on or before it (of two with one date the first), else the earliest block. The block spans from its header row to the
    next header row. Two scalars pick the block (one aggregate over the headers); the rows
    are then a range filter on row_idx, so nothing is windowed over the whole sheet."""
    blocks = ad_blocks(sheet, text_cols, date_col)
    pick = blocks.agg(
        F.max(F.when(F.col("ad_date") <= F.lit(target), F.struct("ad_date", (-F.col("row_idx")).alias("up"), "row_idx"))).alias("past"),
        F.min(F.struct("ad_date", "row_idx")).alias("first")).first()
    chosen = pick["past"] or pick["first"]
    if chosen is None:
        return sheet.sparkSession.createDataFrame([], "ad_week date, row_idx bigint, item string")
    start = chosen["row_idx"]
    nxt = blocks.filter(F.col("row_idx") > F.lit(start)).agg(F.min("row_idx")).first()[0]
    rows = sheet.filter(F.col("row_idx") >= F.lit(start))
    if nxt is not None:
        rows = rows.filter(F.col("row_idx") < F.lit(nxt))
    item = F.trim(F.regexp_replace(F.col(item_col).cast("string"), r"\s+", " "))
    text = _row_text(list(text_cols))
    head = None
    for m in AD_BLOCK_MARKS:
        c = F.instr(text, F.lit(m)) > 0
        head = c if head is None else (head | c)
    keep = (F.col(item_col).isNotNull() & (item != "") & (F.lower(item) != "item") & ~head
            & (F.lower(F.trim(F.coalesce(F.col(type_col).cast("string"), F.lit("")))) != "type"))
    return rows.filter(keep).select(F.lit(chosen["ad_date"]).alias("ad_week"), "row_idx", item.alias("item"))


def report_items(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """Landed report pages -> one row per sale item, each page for itself (``report_lines`` reads whole reports).
    Items without a product code are dropped."""
    items, _ = page_items(body_col)
    raw = pages.select("page", F.posexplode(items).alias("pos", "j"))
    rec = raw.select("page", "pos", F.from_json("j", SALES_ITEM_SCHEMA).alias("r")).select("page", "pos", "r.*")
    return rec.filter(F.trim(F.coalesce(F.col("productCode"), F.lit(""))) != "")


PAGE_ROWS = 500


def page_items(body) -> tuple[F.Column, F.Column]:
    """Of a landed page: its items as an array of JSON texts (an object's ``items`` or the page itself, if it is a list;
    each unwrapped from ``{"item": ...}``; anything else than a filled object left out), and its ``estimatedTotal``."""
    body = F.col(body)
    is_list = F.startswith(F.ltrim(body), F.lit("["))
    raw = F.when(is_list, F.from_json(body, "array<string>")).otherwise(F.from_json(body, "items array<string>")["items"])
    leaf = F.transform(raw, lambda j: F.when(F.array_contains(F.json_object_keys(j), "item"), F.get_json_object(j, "$.item")).otherwise(j))
    filled = F.filter(leaf, lambda x: x.isNotNull() & F.startswith(F.ltrim(x), F.lit("{")) & (F.regexp_replace(x, r"\s", "") != "{}"))
    total = F.when(~is_list, F.get_json_object(body, "$.estimatedTotal").try_cast("bigint"))
    return F.coalesce(filled, F.array().cast("array<string>")), total


def report_lines(pages: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """S05 over whole reports: ``pages`` (report, page, body) -> one row per sale item (report, page, pos, fields).

    A page that landed twice counts once. A report is read page by page until one without items, or until the pages read
    cover the total it last stated; pages past that (left from an earlier, longer pull) are not part of it. Both forms of
    page count. Windows are over the pages of one report, not over items."""
    from pyspark.sql import Window
    once = pages.groupBy("report", "page").agg(F.min("body").alias("body"))
    items, total = page_items("body")
    read = once.select("report", "page", items.alias("items"), total.alias("total"))
    in_order = Window.partitionBy("report").orderBy("page")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    known = F.last("total", ignorenulls=True).over(so_far)
    last = (F.size("items") == 0) | F.coalesce(F.row_number().over(in_order) * page_rows >= known, F.lit(False))
    kept = (read.withColumn("last", last).withColumn("ended", F.coalesce(F.max("last").over(before), F.lit(False)))
                .filter("NOT ended"))
    rec = kept.select("report", "page", F.posexplode("items").alias("pos", "j")).select(
        "report", "page", "pos", F.from_json("j", SALES_ITEM_SCHEMA).alias("r")).select("report", "page", "pos", "r.*")
    return rec.filter(F.trim(F.coalesce(F.col("productCode"), F.lit(""))) != "")


# --- S07 newest report file -----------------------------------------------------------------

def list_files(spark, folder: str, pattern: str = "*") -> DataFrame:
    """File listing (path, name, mtime, size) of a folder; the content column is never read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
                 .select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                         F.col("modificationTime").alias("mtime"), F.col("length").alias("size")))


def report_files(listing: DataFrame, folder_rank: str | None = None) -> DataFrame:
    """One report per data date - date from the file name (``YYYY-MM-DD`` or
    ``M.D.YY``), else the file's modification day; lock files (``~$``) skipped; when several
    files carry the same date the one from the best-ranked folder (then newest) wins."""
    from ..functions.months import file_date
    df = listing.filter(~F.col("name").startswith("~$"))
    df = df.withColumn("data_date", F.coalesce(file_date(F.col("name")), F.to_date("mtime")))
    rank = F.col(folder_rank) if folder_rank else F.lit(0)
    best = df.groupBy("data_date").agg(
        F.min_by(F.struct("path", "name", "mtime"), F.struct(rank.alias("r"), (-F.unix_micros(F.col("mtime").cast("timestamp"))).alias("t"), F.col("path").alias("p"))).alias("f"))
    return best.select("data_date", "f.path", "f.name", "f.mtime")


def newest_report(listing: DataFrame, folder_rank: str | None = None):
    """The newest report's (data_date, path), or None."""
    r = report_files(listing, folder_rank).orderBy(F.col("data_date").desc()).limit(1).first()
    return None if r is None else (r["data_date"], r["path"])


# --- S03 positional buyer master ---------------------------------------------------------------

# fixed values: the buyer master's column positions (0-based) and the header rows to skip
BUYER_MASTER_COLUMNS = {"code": 8, "description": 9, "category": 12, "units_case": 15, "deal": 16,
                        "case_cost": 19, "min_cases": 21, "net_unit": 25, "discount": 26, "retail": 27,
                        "margin": 29}
BUYER_MASTER_HEADER_ROWS = 3


def buyer_master(raw: DataFrame, columns=None, header_rows: int = BUYER_MASTER_HEADER_ROWS) -> DataFrame:
    """A header-less CSV read (``_c0`` ..) or a cell sheet (``c0`` ..) -> named columns
    by position, the first ``header_rows`` rows (by ``row_idx``) dropped. Missing positions
    come out as NULL."""
    cols = columns or BUYER_MASTER_COLUMNS
    prefix = "_c" if "_c0" in raw.columns else "c"
    out = raw.filter(F.col("row_idx") >= header_rows) if "row_idx" in raw.columns else raw
    sel = [(F.col(f"{prefix}{i}") if f"{prefix}{i}" in raw.columns else F.lit(None).cast("string")).alias(name)
           for name, i in cols.items()]
    return out.select(*(["row_idx"] if "row_idx" in raw.columns else []), *sel)


# --- S11 sinks -------------------------------------------------------------------------------------

def write_sheet(df: DataFrame, path: str, fmt: str = "parquet", *, gzip: bool = False, single_file: bool = False) -> None:
    """One dataset per logical sheet (order, snapshot, store orders ...); CSV with a
    header, gzip for the large ones. ``single_file`` is for small sheets a person opens."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
        if gzip:
            w = w.option("compression", "gzip")
        w.csv(path)
    else:
        w.parquet(path)


# --- W09 carry the block header forward to every row -------------------------------------------

def carry_forward_block(sheet: DataFrame, blocks: DataFrame, order_col: str = "row_idx",
                        ranges: int | None = None) -> DataFrame:
    """Every sheet row with the header row (and ad date) of the block it sits in - the
    last header at or before it; rows before the first header get NULL.

    No window over the whole sheet: rows are range-partitioned on ``order_col`` (pinned by
    a checkpoint), each range finds its last header locally, and a range without one takes
    the last header of the ranges before it (an array with one entry per range)."""
    from pyspark.sql import Window
    from ..session import durable
    spark = sheet.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    heads = blocks.select(F.col(order_col).alias("_h"), F.col("ad_date").alias("_d"))
    tagged = sheet.join(heads, F.col(order_col) == F.col("_h"), "left")
    ranged = durable(tagged.repartitionByRange(n, order_col).withColumn("_rng", F.spark_partition_id()))
    w = Window.partitionBy("_rng").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    head = F.when(F.col("_h").isNotNull(), F.struct("_h", "_d"))
    local = ranged.withColumn("_lh", F.last(head, ignorenulls=True).over(w))
    lasts = ranged.groupBy("_rng").agg(F.max(head).alias("_last")).agg(F.collect_list(F.struct("_rng", "_last")).alias("_all"))
    carry = lasts.select("_all", F.explode("_all").alias("_r")).select(
        F.col("_r._rng").alias("_rng"),
        F.array_max(F.transform(F.filter("_all", lambda x: x["_rng"] < F.col("_r._rng")), lambda x: x["_last"])).alias("_before"))
    out = local.join(carry, "_rng", "left").withColumn("_at", F.coalesce("_lh", "_before"))
    return out.select(*[c for c in sheet.columns], F.col("_at._h").alias("block_row"), F.col("_at._d").alias("ad_date"))
