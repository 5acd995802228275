"""Month and date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from ._util import col

# fixed values: month stems in calendar order, and the Sep-Dec shorthand
MONTH_STEMS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
SEP_DEC_SHORTHAND = "sond"


def parse_months_stem(c) -> Column:
    """Months named anywhere in a cell, as a sorted array<int>; 'sond' adds Sep-Dec.
    Empty array = no buy-month constraint."""
    s = F.lower(F.trim(F.coalesce(col(c).cast("string"), F.lit(""))))
    hits = [F.when(s.contains(stem), F.lit(i + 1)) for i, stem in enumerate(MONTH_STEMS)]
    sond = F.when(s.contains(SEP_DEC_SHORTHAND), F.array(*[F.lit(m) for m in (9, 10, 11, 12)])) \
        .otherwise(F.array().cast("array<int>"))
    arr = F.concat(F.filter(F.array(*hits), lambda x: x.isNotNull()), sond)
    return F.array_sort(F.array_distinct(F.when(s == "nan", F.array().cast("array<int>")).otherwise(arr)))


def parse_months_token(c) -> Column:
    """Token-wise parse: each [a-z0-9]+ token whose first 3 letters are a month stem, or an
    integer 1-12. Sorted distinct array<int>."""
    toks = F.split(F.lower(F.coalesce(col(c).cast("string"), F.lit(""))), r"[^a-z0-9]+")
    stems = F.array(*[F.lit(s) for s in MONTH_STEMS])

    def month_of(t):
        pos = F.array_position(stems, F.substring(t, 1, 3)).cast("int")
        num = F.when(t.rlike(r"^[0-9]+$") & (F.length(t) <= 2), t.cast("int"))
        return F.when(pos > 0, pos).when((num >= 1) & (num <= 12), num)

    found = F.filter(F.transform(toks, month_of), lambda m: m.isNotNull())
    return F.array_sort(F.array_distinct(found))


def weeks_to_next_buy_month(months, current_month) -> Column:
    """0 when the current month is not a buy month; else weeks until the next *other* buy
    month (12 months when there is only one), x 4.345, capped at 52."""
    cur = col(current_month)
    ms = F.coalesce(col(months), F.array().cast("array<int>"))
    ahead = F.filter(F.transform(ms, lambda m: F.pmod(m - cur, F.lit(12))), lambda d: d != 0)
    gap = F.coalesce(F.array_min(ahead), F.lit(12))
    wks = F.least(gap * F.lit(config.WEEKS_PER_MONTH), F.lit(config.MAX_STOCKUP_WEEKS))
    return F.when(F.array_contains(ms, cur), wks).otherwise(F.lit(0.0))


def file_date(name) -> Column:
    """Data date in a file name: 'YYYY-M-D' (separators - _ .) first, else 'M.D.YY'.
    Invalid dates are NULL (the caller falls back to the file's modification time)."""
    n = col(name)
    p1 = r"(20\d{2})[-_.](\d{1,2})[-_.](\d{1,2})"
    a = _make_date(F.regexp_extract(n, p1, 1), F.regexp_extract(n, p1, 2), F.regexp_extract(n, p1, 3))
    p2 = r"\b(\d{1,2})[.](\d{1,2})[.](\d{2})\b"
    b = _make_date(F.concat(F.lit("20"), F.regexp_extract(n, p2, 3)),
                   F.regexp_extract(n, p2, 1), F.regexp_extract(n, p2, 2))
    return F.coalesce(a, b)


def _make_date(y, m, d) -> Column:
    s = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(F.length(y) >= 4, F.try_to_date(s, "yyyy-MM-dd"))


def fourth_thursday_of_november(year) -> Column:
    """4th Thursday of November of ``year``."""
    return F.date_add(F.next_day(F.make_date(col(year), F.lit(10), F.lit(31)), "Thu"), 21)


def month_abbr(m) -> Column:
    """1 -> 'Jan' ... 12 -> 'Dec'."""
    return F.element_at(F.array(*[F.lit(x) for x in config.MONTH_ABBR]), col(m).cast("int"))
