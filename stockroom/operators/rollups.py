"""Group-by rollups.

"First"/"last" in the source data means file order; here every input carries an ingest
row number and first/last become ``min_by``/``max_by`` on it, so results are deterministic
on any partitioning. All of these are hash aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.codes import norm_code


def first_by(c: str, order: str = "ingest_row", skip_empty: bool = False) -> Column:
    """Value of ``c`` on the earliest row (by ``order``) where it is not null (nor '' when
    ``skip_empty``)."""
    ok = F.col(c).isNotNull()
    if skip_empty:
        ok = ok & (F.trim(F.col(c).cast("string")) != "")
    return F.min_by(F.col(c), F.when(ok, F.col(order)))


def item_rollup(needs: DataFrame, keys=("dept", "item")) -> DataFrame:
    """Per item - first code/category/supplier, summed OH / 30D / 90D / LY, median cost,
    largest case pack (0 or missing -> 1), any par."""
    return with_case(needs.groupBy(*keys).agg(*item_aggregates()))


def with_case(g: DataFrame) -> DataFrame:
    return g.withColumn("case", F.when(F.col("case_pack").isNull() | (F.col("case_pack") == 0), 1.0)
                               .otherwise(F.col("case_pack")))


def item_aggregates() -> list[Column]:
    """A01's aggregates of the store rows of an item."""
    return [
        first_by("code").alias("code"),
        first_by("code_key").alias("code_key"),
        first_by("category").alias("category"),
        first_by("supplier").alias("supplier"),
        F.sum("on_hand").alias("chain_oh"),
        F.sum("u30").alias("u30"),
        F.sum("u90").alias("u90"),
        F.sum("u_ly4").alias("u_ly4"),
        F.median("cost").alias("cost"),
        F.max("case_pack").alias("case_pack"),
        F.bool_or("has_par").alias("has_par")]


def chain_by_code(inv: DataFrame) -> DataFrame:
    """Per code - chain OH / 30D / 90D, median price, first category, blended velocity."""
    g = inv.groupBy("code_key").agg(
        F.sum("on_hand").alias("oh"), F.sum("u30").alias("u30"), F.sum("u90").alias("u90"),
        F.median("price_raw").alias("price"), first_by("category").alias("category"))
    vel = F.lit(config.BLEND_30) * F.col("u30") * 7 / 30 + F.lit(config.BLEND_90) * F.col("u90") * 7 / 90
    return g.withColumn("vel", vel)


def coalesce_by_code(df: DataFrame, key: str, fields: list[str], order: str = "ingest_row") -> DataFrame:
    """First non-empty value *per field* across repeated rows of a key."""
    return df.groupBy(key).agg(*[first_by(f, order, skip_empty=True).alias(f) for f in fields])


def tab_items(tab: DataFrame, code: str, item: str, order: str) -> DataFrame:
    """(code, item) of any list tab: rows with a code and an item, the first row of a code."""
    named = tab.select(norm_code(code).alias("code"), F.trim(F.col(item)).alias("item"), order)
    named = named.filter((F.col("code") != "") & (F.coalesce(F.col("item"), F.lit("")) != "") & (F.lower("item") != "nan"))
    return dedupe_keep(named, ["code"], order, keep="first").select("code", "item")


def dedupe_keep(df: DataFrame, keys: list[str], order: str, keep: str = "last") -> DataFrame:
    """One row per key, the last (or first) by ``order`` - deterministic, unlike
    ``dropDuplicates``."""
    # an aggregate (max_by / min_by of the whole row) rather than a row_number window: it
    # combines map-side, so a key repeated on a large share of the rows is never one task
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    return (df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
              .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))
