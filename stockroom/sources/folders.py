"""Folders of workbooks read in one plan.

Input: one row per sheet row - ``file``, ``sheet``, ``sheet_no`` (place in its workbook), ``row_idx`` (from 0) and
``cells`` (array of strings). Workbooks differ in sheets, header rows, column order and width. Which row is a
sheet's header and where each field stands is an aggregate per (file, sheet) with map-side combine; its result is one
small row per sheet, with the fields' positions as a map column, so thousands of differently laid out sheets are read
by one join and one ``select`` and nothing goes through the driver. A sheet that holds most of the rows is split like any
other table: only the rows of headers are grouped.

Nulls: a null cell counts as empty; a sheet without a header row, or a workbook without a fitting sheet, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import norm_code
from ..functions.months import parse_months_stem
from ..functions.numeric import round_even
from ..operators.rollups import coalesce_by_code, dedupe_keep
from .sheets import INVENTORY_REQUIRED, INVENTORY_SCORE, MONEY_NAMES, MONEY_WORDS

SHEET = ["file", "sheet"]

# fixed values: the code label that marks a header row, how many rows may hold it, and the least width of a price sheet
HEADER_MARK = "Product UPC"
HEADER_ROWS = 4
TAB_LABELS = {"code": "Product UPC", "item": "Product Description"}
TAB_HEADER_ROWS = 6
PRICE_SHEET_WIDTH = 12
# fixed values: header names of a price sheet's fields
PRICE_ALIASES = {
    "upc": ["product upc"],
    "units": ["units/case", "units / case"],
    "deal": ["deal description"],
    "netunit": ["net/unit", "net unit cost", "net / unit"],
    "casecost": ["net case cost", "invoice cost"],
    "buymonths": ["buy months (if appl.)", "buy months"],
}


def _text(x) -> Column:
    return F.coalesce(x, F.lit(""))


def positions(header: Column, aliases: dict[str, list[str]], exact: bool = False) -> Column:
    """Field -> place (from 0) of the first header cell equal to one of its names, as a map; names match trimmed and
    in lower case, or as they are (``exact``). Header blocks repeat across a sheet, so the first place counts."""
    cells = F.transform(header, lambda x: _text(x) if exact else F.lower(F.trim(_text(x))))
    places = [F.struct(F.lit(field).alias("field"), F.array_min(F.array(*[
        F.nullif(F.array_position(cells, F.lit(n)), F.lit(0)) for n in names])).alias("at")) for field, names in aliases.items()]
    found = F.filter(F.array(*places), lambda p: p["at"].isNotNull())
    return F.map_from_entries(F.transform(found, lambda p: F.struct(p["field"], (p["at"] - 1).cast("int"))))


def elect_headers(rows: DataFrame, mark: str = HEADER_MARK, within: int = HEADER_ROWS) -> DataFrame:
    """(file, sheet, sheet_no, width, header_row, header) of every sheet - the first of its rows before ``within`` with a
    cell that contains ``mark`` (null when there is none), and the number of columns of the whole sheet."""
    marked = (F.col("row_idx") < within) & F.exists("cells", lambda x: F.contains(_text(x), F.lit(mark)))
    head = F.min(F.when(marked, F.struct("row_idx", "cells"))).alias("head")
    return (rows.groupBy(*SHEET).agg(F.min("sheet_no").alias("sheet_no"), F.max(F.size("cells")).alias("width"), head)
                .select(*SHEET, "sheet_no", "width", F.col("head.row_idx").alias("header_row"), F.col("head.cells").alias("header")))


def pick_sheets(heads: DataFrame, fits: Column, rank: list[Column]) -> DataFrame:
    """Of each workbook's fitting sheets the one that ranks highest, the first of equals in workbook order."""
    place = F.struct(*rank, (-F.col("sheet_no")).alias("early"))
    rest = [c for c in heads.columns if c != "file"]
    return (heads.filter(fits).groupBy("file").agg(F.max_by(F.struct(*rest), place).alias("s")).select("file", "s.*"))


def sheet_fields(rows: DataFrame, heads: DataFrame, fields: list[str]) -> DataFrame:
    """The rows below each sheet's header with their fields as columns of text; a field that a sheet lacks is null. ``heads``
    has one row per sheet to read: (file, sheet, header_row, at) with ``at`` from ``positions``."""
    at = heads.select(*SHEET, "header_row", "at")
    body = rows.join(at, SHEET).filter(F.col("row_idx") > F.col("header_row"))
    return body.select(*SHEET, "row_idx", *[F.get("cells", F.col("at")[f]).alias(f) for f in fields])


# --- S01: inventory workbooks ----------------------------------------------------------------------

INVENTORY_FIELDS = {"item": ["Product Description"], "store": ["Location Name"], "on_hand": ["OH"], "u30": ["30D"], "u90": ["90D"]}


def inventory_sheets(rows: DataFrame) -> DataFrame:
    """Each workbook's inventory sheet - its first row names the required columns, and its score is the highest."""
    heads = rows.filter("row_idx = 0").select(*SHEET, "sheet_no", F.col("row_idx").alias("header_row"), F.col("cells").alias("header"))
    has = lambda name: F.coalesce(F.array_contains("header", name), F.lit(False))
    fits = F.lit(True)
    for name in sorted(INVENTORY_REQUIRED):
        fits = fits & has(name)
    score = sum((F.when(has(name), points).otherwise(0) for name, points in INVENTORY_SCORE.items()), F.lit(0))
    best = pick_sheets(heads.withColumn("score", score), fits, [F.col("score")])
    return best.withColumn("at", positions(F.col("header"), INVENTORY_FIELDS, exact=True))


def inventory_rows(rows: DataFrame) -> DataFrame:
    """The item rows of every workbook's inventory sheet; numbers that cannot be read are 0."""
    got = sheet_fields(rows, inventory_sheets(rows), list(INVENTORY_FIELDS))
    numbers = {c: F.coalesce(F.trim(c).try_cast("double"), F.lit(0.0)) for c in ["on_hand", "u30", "u90"]}
    return got.filter(F.trim(_text(F.col("item"))) != "").withColumns(numbers | {"item": F.trim("item")})


# --- S04 + A06: price sheets -----------------------------------------------------------------------

def department_of(file: str = "file") -> Column:
    """The department a workbook is named after: the first word of its file name."""
    return F.split(F.element_at(F.split(F.col(file), "/"), -1), " ")[0]


def price_sheets(rows: DataFrame, aliases=None, width: int = PRICE_SHEET_WIDTH) -> DataFrame:
    """Each workbook's price sheet: wide enough, with a header row; one named after the department comes before the
    others. Workbooks without a code column or without any cost column are left out."""
    heads = elect_headers(rows)
    named = F.contains(F.lower("sheet"), F.lower(department_of()))
    best = pick_sheets(heads.withColumn("named", named), (F.col("width") >= width) & F.col("header_row").isNotNull(), [F.col("named")])
    best = best.withColumn("at", positions(F.col("header"), aliases or PRICE_ALIASES))
    return best.filter(F.col("at")["upc"].isNotNull() & (F.col("at")["netunit"].isNotNull() | F.col("at")["casecost"].isNotNull()))


def price_reference(rows: DataFrame, aliases=None) -> DataFrame:
    """The cost reference of a folder of price workbooks: per code its department, buyer cost (net unit cost, else case cost by
    units), deal text and buy months, each the first that is not empty in the order of files and rows."""
    aliases = aliases or PRICE_ALIASES
    got = sheet_fields(rows, price_sheets(rows, aliases), list(aliases))
    num = lambda c: F.trim(c).try_cast("double")
    per_unit = F.when(num("units") != 0, num("casecost") / num("units"))
    deal = F.trim(_text(F.col("deal")))
    rec = got.select(
        norm_code("upc").alias("code_key"), department_of().alias("department"),
        round_even(F.coalesce(num("netunit"), per_unit), 2).alias("buyer_cost"),
        F.when(F.lower(deal) != "nan", F.nullif(deal, F.lit(""))).alias("deal"),
        F.nullif(F.array_join(F.transform(parse_months_stem("buymonths"), lambda m: m.cast("string")), "|"), F.lit("")).alias("buy_months"),
        F.struct("file", "row_idx").alias("place"))
    told = F.coalesce(F.col("buyer_cost").cast("string"), "deal", "buy_months").isNotNull()
    return coalesce_by_code(rec.filter((F.col("code_key") != "") & told), "code_key", ["department", "buyer_cost", "deal", "buy_months"], "place")


# --- P11: list tabs ----------------------------------------------------------------------------------

def folder_tab_items(rows: DataFrame, tab: str, within: int = TAB_HEADER_ROWS) -> DataFrame:
    """(code, item, department) of the sheet named ``tab`` in every workbook. The labels of code and item may stand on
    different rows: each takes its first place, and the items begin below the later of the two. The first row of a
    code stays, in the order of files and rows."""
    mine = rows.filter(F.col("sheet") == tab)

    def place(label):
        at = F.array_position(F.transform("cells", lambda x: F.contains(_text(x), F.lit(label))), True)
        return F.min(F.when((F.col("row_idx") < within) & (at > 0), F.struct("row_idx", (at - 1).cast("int").alias("at"))))

    heads = mine.groupBy(*SHEET).agg(*[place(label).alias(f) for f, label in TAB_LABELS.items()])
    heads = heads.filter("code IS NOT NULL AND item IS NOT NULL").select(
        *SHEET, F.greatest("code.row_idx", "item.row_idx").alias("header_row"),
        F.create_map(F.lit("code"), F.col("code.at"), F.lit("item"), F.col("item.at")).alias("at"))
    got = sheet_fields(mine, heads, ["code", "item"]).select(
        norm_code("code").alias("code"), F.trim(_text(F.col("item"))).alias("item"), department_of().alias("department"),
        F.struct("file", "row_idx").alias("place"))
    got = got.filter((F.col("code") != "") & (F.col("item") != "") & (F.lower("item") != "nan"))
    return dedupe_keep(got, ["code"], "place", keep="first").select("code", "item", "department")


# --- P12 + P13: one profile for all columns of all sheets ----------------------------------------------

def column_profile(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Per (file, sheet, column place): the header name, body rows, filled cells, numbers, positive ones, ones with cents, cells
    that look like product codes, and the total. One pass over all sheets; every figure is a sum, so partial profiles
    add up and no sheet is one task's. ``heads`` (file, sheet, header_row, header) has one row per sheet."""
    body = rows.join(heads.select(*SHEET, "header_row", "header"), SHEET).filter(F.col("row_idx") > F.col("header_row"))
    body = body.filter(F.exists("cells", lambda x: _text(x) != ""))
    cells = F.transform(F.sequence(F.lit(0), F.size("header") - 1), lambda i: F.struct(i.alias("at"), _text(F.get("cells", i)).alias("x")))
    each = body.filter(F.size("header") > 0).select(*SHEET, "header", F.explode(cells).alias("c")).select(
        *SHEET, "c.at", F.trim(_text(F.get("header", F.col("c.at")))).alias("name"), "c.x")
    v = F.regexp_replace("x", r"[$,]", "").try_cast("double")
    each = each.withColumn("v", v)
    return each.groupBy(*SHEET, "at", "name").agg(
        F.count("*").alias("rows"), F.count_if(F.col("x") != "").alias("filled"), F.count("v").alias("numbers"),
        F.count_if(F.col("v") > 0).alias("positive"), F.count_if(F.abs(F.col("v") % 1) > 1e-9).alias("cents"),
        F.count_if(F.length(F.regexp_replace("x", r"\D", "")).between(11, 14)).alias("codes"),
        F.sum(F.col("v").cast("decimal(28,4)")).alias("total"))


def choose_columns(profile: DataFrame) -> DataFrame:
    """P12 + P13 for every sheet of a profile: the column with the most product codes (at least a third of the rows and three), and
    the order-dollar column: the first with an exact name, else among columns that are >= 60 % numeric and >= 80 %
    positive the best by (money word, >= 30 % with cents, total). Nulls where no column fits."""
    name = F.lower("name")
    exact = F.array_position(F.array(*[F.lit(n) for n in MONEY_NAMES]), name)
    fits = (F.col("numbers") / F.col("rows") >= 0.6) & (F.col("positive") / F.nullif("numbers", F.lit(0)) >= 0.8)
    left = (-F.col("at")).alias("left")
    guess = F.struct(F.rlike(name, F.lit(MONEY_WORDS)).alias("worded"), (F.col("cents") / F.nullif("numbers", F.lit(0)) >= 0.3).alias("c"), "total", left)
    coded = F.col("codes") >= F.greatest(F.lit(3), F.floor(F.col("rows") / 3))
    best = profile.groupBy(*SHEET).agg(
        F.max(F.when(coded, F.struct("codes", left))).alias("code"),
        F.min(F.when(exact > 0, F.struct(exact.alias("rank"), "at"))).alias("exact"),
        F.max(F.when(fits, guess)).alias("guess"))
    return best.select(*SHEET, (-F.col("code.left")).alias("code_at"), F.coalesce(F.col("exact.at"), -F.col("guess.left")).alias("money_at"),
                       F.col("exact").isNull().alias("guessed"))
