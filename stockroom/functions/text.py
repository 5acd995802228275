"""Free-text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from ._util import col


def brand_of(name) -> Column:
    """First word; the first two words when the first (minus quotes and 's') is in the
    two-word brand list."""
    toks = F.split(F.trim(F.coalesce(col(name).cast("string"), F.lit(""))), r"\s+")
    first = F.element_at(toks, 1)
    key = F.regexp_replace(F.regexp_replace(F.lower(first), r"^['s]+", ""), r"['s]+$", "")
    two = F.array(*[F.lit(w) for w in config.TWO_WORD_BRANDS])
    return (F.when(first == "", F.lit(""))
            .when(F.array_contains(two, key) & (F.size(toks) > 1),
                  F.concat_ws(" ", first, F.element_at(toks, 2)))
            .otherwise(first))


def potency_of(name) -> Column:
    """First '<digits> mg' / '<digits>mg' (any case) as an int; NULL when absent or too long for one."""
    s = F.regexp_extract(F.coalesce(col(name).cast("string"), F.lit("")), r"(?i)(\d+)\s?mg", 1)
    return F.when(s != "", s.try_cast("bigint"))


def expand_ad_line(raw) -> Column:
    """An ad line -> array<struct<q string, is_brand boolean>>: split on '/', flag whole-brand
    wording, strip that wording from the query."""
    parts = F.filter(F.transform(F.split(F.coalesce(col(raw).cast("string"), F.lit("")), r"\s*/\s*"),
                                 lambda p: F.trim(p)), lambda p: p != "")

    def one(p):
        q = F.regexp_replace(p, r"(?i)\(all[^)]*\)", " ")
        q = F.regexp_replace(q, r"(?i)\ball (types|varietals|flavors|varieties)\b", " ")
        q = F.regexp_replace(q, r"(?i)\ball\b", " ")
        q = F.trim(F.regexp_replace(q, r"\s+", " "))
        return F.struct(F.when(q == "", p).otherwise(q).alias("q"),
                        p.rlike(config.BRAND_SIGNAL).alias("is_brand"))

    return F.transform(parts, one)


def expand_abbrev(norm_query) -> Column:
    """Whole-token abbreviation expansion on a normalised (space-separated) query."""
    m = F.create_map(*[x for k, v in config.ABBREVIATIONS.items() for x in (F.lit(k), F.lit(v))])
    toks = F.split(col(norm_query), " ")
    return F.array_join(F.transform(toks, lambda t: F.coalesce(F.element_at(m, t), t)), " ")


def join_text(parts, sep: str = "; ") -> Column:
    """Join the non-null, non-empty parts with ``sep``."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), sep)


def query_words(text: str) -> list[str]:
    """Words of a free-text question: [a-z0-9]{3,} runs, stop-words removed (driver-side
    parameter parsing, not data processing)."""
    import re
    return [w for w in re.findall(r"[a-z0-9]{3,}", (text or "").lower()) if w not in config.STOP_WORDS]


def keyword_score(name, words: list[str]) -> Column:
    """How many of ``words`` occur in the lower-cased name."""
    low = F.lower(F.coalesce(col(name).cast("string"), F.lit("")))
    arr = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    return F.aggregate(arr, F.lit(0), lambda acc, w: acc + F.when(F.instr(low, w) > 0, 1).otherwise(0))
