"""Product-code and name helpers (F01, F02, F09, F10, F11). All return Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col


def digits(c) -> Column:
    """Digits only ('0086-12.0' -> '0086120')."""
    return F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"\D", "")


def norm_code(c) -> Column:
    """Product key: a float-text '.0' tail dropped, digits only, leading zeros stripped;
    an all-zero code keeps its digits ('000' stays '000')."""
    s = F.regexp_replace(F.trim(col(c).cast("string")), r"\.0$", "")
    d = F.regexp_replace(F.coalesce(s, F.lit("")), r"\D", "")
    stripped = F.regexp_replace(d, r"^0+", "")
    return F.when(stripped == "", d).otherwise(stripped)


def clean_code(c) -> Column:
    """Display form of a code: trailing '.0' removed, trimmed, null -> ''."""
    return F.coalesce(F.trim(F.regexp_replace(col(c).cast("string"), r"\.0$", "")), F.lit(""))


def norm_text(c) -> Column:
    """Lower case, anything but [a-z0-9 ] -> space, spaces squeezed, trimmed."""
    s = F.regexp_replace(F.lower(F.coalesce(col(c).cast("string"), F.lit(""))), r"[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def squeeze_lower(c) -> Column:
    """Lower case with whitespace squeezed (free-text key of an uploaded sheet)."""
    return F.regexp_replace(F.trim(F.lower(F.coalesce(col(c).cast("string"), F.lit("")))), r"\s+", " ")


def norm_val(c) -> Column:
    """Facet key: lower case with all whitespace removed."""
    return F.regexp_replace(F.lower(F.coalesce(col(c).cast("string"), F.lit(""))), r"\s+", "")


def safe_name(c, max_len: int = 60) -> Column:
    """File-safe vendor name: characters other than word, space, '.', '-' -> '_', trimmed,
    'Unknown' when empty. A longer name keeps its first ``max_len`` characters and gets a hash of the
    whole name, so two long names never share a file."""
    raw = F.coalesce(col(c).cast("string"), F.lit(""))
    s = F.trim(F.regexp_replace(raw, r"(?U)[^\w .-]", "_"))
    long = F.concat(F.substring(s, 1, max_len), F.lit("-"), F.substring(F.md5(raw), 1, 8))
    return F.when(s == "", F.lit("Unknown")).when(F.length(s) > max_len, long).otherwise(s)


def parse_by_store(c) -> Column:
    """'a:1;b:2' -> array<struct<store string, qty bigint>>; split on the last colon, quantity
    truncated toward zero; parts without a colon or with a non-numeric quantity are skipped."""
    parts = F.split(F.coalesce(col(c).cast("string"), F.lit("")), ";")
    pairs = F.transform(parts, lambda p: F.struct(
        F.trim(F.regexp_extract(p, r"^(.*):([^:]*)$", 1)).alias("store"),
        F.regexp_extract(p, r"^(.*):([^:]*)$", 2).try_cast("double").cast("bigint").alias("qty"),
        p.contains(":").alias("ok")))
    good = F.filter(pairs, lambda s: s["ok"] & s["qty"].isNotNull())
    return F.transform(good, lambda s: F.struct(s["store"].alias("store"), s["qty"].alias("qty")))
