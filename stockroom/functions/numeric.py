"""Numeric coercion and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col


def num_or_zero(c) -> Column:
    """Parse as double; anything unparseable or missing -> 0."""
    return F.coalesce(col(c).cast("string").try_cast("double"), F.lit(0.0))


def money_or_zero(c) -> Column:
    """'$1,234.50' -> 1234.5; '$' and ',' stripped, bad -> 0."""
    s = F.trim(F.regexp_replace(col(c).cast("string"), r"[$,]", ""))
    return F.coalesce(s.try_cast("double"), F.lit(0.0))


def loose_num(c) -> Column:
    """Keep only [0-9.-] then parse; '', '-', '.' or garbage -> NULL."""
    s = F.regexp_replace(col(c).cast("string"), r"[^0-9.\-]", "")
    return s.try_cast("double")


def round_even(c, scale: int = 0) -> Column:
    """numpy/pandas rounding: scale by 10^d, round half to even, scale back (so a value that
    prints as ...5 but is stored just below rounds the way numpy does); '+ 0.0' turns -0.0
    into 0.0."""
    if scale == 0:
        return F.bround(col(c), 0) + F.lit(0.0)
    f = float(10 ** scale)
    return F.bround(col(c) * f, 0) / f + F.lit(0.0)


def trend_label(ratio) -> Column:
    """rising at >= 1.2, falling at <= 0.8, steady otherwise."""
    r = col(ratio)
    return F.when(r >= 1.2, "rising").when(r <= 0.8, "falling").otherwise("steady")


def trend_pct(vel30, vel90) -> Column:
    """% of the 30-day pace over the 12-week pace, 0 dp; NULL when no 12-week pace."""
    return F.when(col(vel90) > 0, round_even((col(vel30) / col(vel90) - 1) * 100, 0))


def staleness_days(data_date, today) -> Column:
    return F.datediff(col(today), col(data_date))


def age_label(seconds) -> Column:
    """Humanised age of a stamp given in seconds: sec / min / hours / days ago (truncated)."""
    t = col(seconds)
    return (F.when(t.isNull(), "")
            .when(t < 90, F.concat(t.cast("bigint").cast("string"), F.lit(" sec ago")))
            .when(t < 5400, F.concat((t / 60).cast("bigint").cast("string"), F.lit(" min ago")))
            .when(t < 129600, F.concat((t / 3600).cast("bigint").cast("string"), F.lit(" hours ago")))
            .otherwise(F.concat((t / 86400).cast("bigint").cast("string"), F.lit(" days ago"))))
