"""Reading loosely laid-out sheets.

Uploaded sheets and buyer workbooks put their header on some early row and name columns
freely. Which row is the header and which column holds the code or the money is one profiling
aggregate over the whole sheet each; Spark ranks the candidates and the driver reads the winner.
The data itself is then a plain ``select`` over the whole frame.

A raw sheet is a DataFrame of string cells ``c0 .. cN`` plus ``row_idx`` (file order).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import loose_num

# fixed values: header patterns of the upload columns, tried in this order
COLUMN_PATTERNS = {
    "upc": [r"\bupc\b", r"gtin", r"product\s*code", r"item\s*code", r"^code$", r"barcode", r"sku"],
    "desc": [r"descri", r"product", r"item\s*name", r"^item$", r"^name$", r"title"],
    "price": [r"net.?unit", r"unit\s*cost", r"\bcost\b", r"\bprice\b", r"each", r"\$"],
    "qty": [r"\bqty\b", r"quantit", r"cases", r"on.?hand", r"\bavail", r"count", r"units"],
}
# fixed values: order-dollar column names, and the words hinting at money in a header
MONEY_NAMES = ["net buy $", "net buy", "order $", "extended cost", "ext cost", "ext price", "extended price",
               "total $", "total cost", "line total", "order total", "ext $", "net $"]
MONEY_WORDS = r"\$|cost|amount|extend|\bext\b|price|total|value|net buy"


# fixed values: what an inventory sheet must have, and what speaks for one
INVENTORY_REQUIRED = {"OH", "Product Description"}
INVENTORY_SCORE = {"TOH": 1, "PM": 1, "30D": 1, "90D": 1, "Location Name": 2}


def pick_inventory_sheet(sheets: dict[str, list[str]]) -> str | None:
    """Of a workbook's sheets (name -> header names) the one with the required columns and the
    highest score; the first of equals."""
    score = {name: sum(INVENTORY_SCORE.get(str(c), 0) for c in set(columns)) for name, columns in sheets.items()
             if INVENTORY_REQUIRED <= {str(c) for c in columns}}
    return max(score, key=score.get, default=None)


def cell_cols(df: DataFrame) -> list[str]:
    return sorted((c for c in df.columns if re.fullmatch(r"c\d+", c)), key=lambda c: int(c[1:]))


def _filled(c: str) -> F.Column:
    """Is the cell non-empty? Plain comparisons for each cell, as lambdas over an array of them run uncompiled on every row."""
    return F.coalesce(F.col(c).cast("string") != "", F.lit(False))


def _any(tests) -> F.Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def header_row(sheet: DataFrame) -> int | None:
    """row_idx of the header - the first row with at least two non-empty cells of which one is
    not a number (the first row of all when there is none)."""
    cols = cell_cols(sheet)
    n_filled = sum((_filled(c).cast("int") for c in cols), F.lit(0))
    named = (n_filled >= 2) & _any(_filled(c) & loose_num(c).isNull() for c in cols)
    return sheet.agg(F.coalesce(F.min(F.when(named, F.col("row_idx"))), F.min("row_idx"))).first()[0]


def sheet_body(sheet: DataFrame) -> tuple[list[str], DataFrame]:
    """(header names, body rows after the header that have any non-empty cell)."""
    cols = cell_cols(sheet)
    at = header_row(sheet)
    if at is None:
        return [], sheet.limit(0)
    names = sheet.filter(F.col("row_idx") == at).select(
        F.array(*[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cols])).first()[0]
    return names, sheet.filter((F.col("row_idx") > at) & _any(map(_filled, cols)))


def resolve_aliases(headers: list[str], aliases: dict[str, list[str]]) -> dict[str, int]:
    """Field -> index of the first header cell equal (trimmed, lower-cased) to one of
    its aliases; header blocks repeat across a sheet, so the first occurrence wins."""
    out: dict[str, int] = {}
    for j, h in enumerate(headers):
        v = str(h or "").strip().lower()
        for key, names in aliases.items():
            if key not in out and v in names:
                out[key] = j
    return out


def _winner(profile: DataFrame, rank: list[str], fits: F.Column) -> int | None:
    """Position of the fitting column that ranks highest (the leftmost of equals)."""
    best = profile.filter(fits).agg(F.max(F.struct(*[F.col(c) for c in rank], (-F.col("at")).alias("left"))).alias("w")).first()["w"]
    return None if best is None else -best["left"]


def _stacked(body: DataFrame, n: int, value) -> DataFrame:
    """(at, v): one row per body row and column, ``value`` of the cell."""
    cells = F.array(*[value(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cell_cols(body)[:n]])
    return body.select(F.posexplode(cells).alias("at", "v"))


def detect_columns(headers: list[str], body: DataFrame) -> dict[str, int | None]:
    """Code / description / price / quantity columns by header pattern; when no header
    names the code, the column with the most 11-14 digit values over all body rows wins if at least
    max(3, rows / 3) of them look like codes."""
    tidy = [" ".join(str(h or "").lower().split()) for h in headers]
    found = {field: next((at for at, h in enumerate(tidy) if re.search("|".join(patterns), h)), None)
             for field, patterns in COLUMN_PATTERNS.items()}
    if found["upc"] is None and headers:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cell_cols(body)[:len(headers)]]
        counts = [F.count_if(F.length(F.regexp_replace(x, r"\D", "")).between(11, 14)) for x in cells]
        profile = body.agg(F.count("*").alias("rows"), F.array(*counts).alias("each")).filter(F.col("rows") > 0).select(
            F.posexplode("each").alias("at", "codes"), "rows")
        found["upc"] = _winner(profile, ["codes"], F.col("codes") >= F.greatest(F.lit(3), F.floor(F.col("rows") / 3)))
    return found


def detect_money_column(headers: list[str], body: DataFrame) -> tuple[int | None, bool]:
    """The order-dollar column. An exact name wins; otherwise, among columns that are
    >= 60 % numeric and >= 80 % positive, the best by (money word in header, >= 30 % with
    cents, largest total). Returns (index, guessed)."""
    low = [str(h or "").strip().lower() for h in headers]
    exact = next((low.index(name) for name in MONEY_NAMES if name in low), None)
    if exact is not None or not headers:
        return exact, exact is None
    worded = F.array(*[F.lit(bool(re.search(MONEY_WORDS, h))) for h in low])
    numbers = _stacked(body, len(headers), lambda x: F.regexp_replace(x, r"[$,]", "").try_cast("double"))
    v, n = F.col("v"), F.count("v")
    profile = numbers.groupBy("at").agg(
        (n / F.count("*") >= 0.6).alias("numeric"), (F.count_if(v > 0) / n >= 0.8).alias("positive"),
        (F.count_if(F.abs(v % 1) > 1e-9) / n >= 0.3).alias("cents"), F.sum("v").alias("total"))
    profile = profile.withColumn("worded", F.element_at(worded, F.col("at") + 1))
    return _winner(profile, ["worded", "cents", "total"], F.col("numeric") & F.col("positive")), True


def tidy_columns(df: DataFrame, *, key: str, drop_like=(), preferred=(), cap: int | None = None) -> DataFrame:
    """P10: of a repeated header name the first column stays, and names ending in "(n)" (a repeated
    header block), blank names and helper columns whose name contains a ``drop_like`` text go. Each
    ``preferred`` text brings the first column containing it to the front. Columns that are empty on
    every row go (one aggregate), and rows with a blank key. ``cap`` keeps the first rows by
    ``row_idx`` only when a caller asks for a size-limited tab."""
    places = df.toDF(*[f"p{k}" for k in range(len(df.columns))])
    wanted = {c: f"p{k}" for k, c in reversed(list(enumerate(df.columns)))}  # the first of equal names
    always = {key, "row_idx"}
    gone = lambda c: not c.strip() or c.strip().lower() == "nan" or re.search(r"\(\d+\)\s*$", c) or any(
        s.lower() in c.lower() for s in drop_like)
    names = [c for c in dict.fromkeys(df.columns) if c in always or not gone(c)]
    out = places.select(*[F.col(wanted[c]).alias(c) for c in names])
    blank = lambda c: F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) == ""
    filled = out.agg(*[F.count_if(~blank(c)).alias(c) for c in names]).first()
    names = [c for c in names if c in always or filled[c]]
    front = dict.fromkeys(next((c for c in names if p.lower() in c.lower()), None) for p in preferred)
    order = [c for c in front if c] + [c for c in names if c not in front]
    out = out.select(*[F.col(f"`{c}`") for c in order]).filter(~blank(key))
    return out if cap is None else out.orderBy("row_idx").limit(cap)
