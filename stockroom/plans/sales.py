"""Live sales rollup (A07, W04) and purchase-order reports."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.codes import safe_name
from ..functions.numeric import round_even, staleness_days
from ..sources.fixtures import AS_OF
from ..session import write_table
from .base import ctx

STORE_ZONE = "America/Chicago"
TOP_PRODUCTS = 25
# sales-line department value -> department group (unknown -> Other). The chain's own map is
# {THC, Beer, Wine, Spirits} to themselves and Miscellaneous/Tobacco -> Other; the fixture's
# event types stand in for departments.
FIXTURE_SALES_DEPTS = {"view": "THC", "click": "Beer", "purchase": "Wine", "signup": "Spirits"}


def _dept_map(c: Column, mapping: dict[str, str]) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.trim(c)), F.lit("Other"))


def live_lines(lines: DataFrame, mapping=None) -> DataFrame:
    """Sale lines with a non-blank code, labelled with the store-local day and department."""
    return (lines.filter(F.trim(F.coalesce(F.col("code"), F.lit(""))) != "")
                 .withColumn("day", F.to_date(F.from_utc_timestamp("ts", STORE_ZONE)))
                 .withColumn("dept", _dept_map(F.col("department"), mapping or FIXTURE_SALES_DEPTS))
                 .withColumn("store", F.trim("store")).withColumn("code", F.trim("code")))


def live_base(lines: DataFrame, mapping=None) -> DataFrame:
    """Sale lines pre-aggregated to (day, dept, store, code): units, sales and the earliest
    sale's (ts, id, description), number of lines. Every rollup level is computed from this
    grain, in batch and in the stream (which sums it over micro-batches)."""
    return (live_lines(lines, mapping)
            .groupBy("day", "dept", "store", "code")
            .agg(F.sum("quantity").alias("u"), F.sum("total").alias("s"), first_sale().alias("first"),
                 F.count("*").alias("n")))


def first_sale() -> Column:
    return F.min_by(F.struct(F.col("ts"), F.col("event_id"), F.trim("description").alias("d")),
                    F.struct(F.col("ts"), F.col("event_id")))


def live_levels(base: DataFrame, top_n: int = TOP_PRODUCTS) -> DataFrame:
    """A07 levels from the (day, dept, store, code) grain: chain, department, department x
    store and the top products per department x day, as flat rows labelled by ``level``: one pass over the grain by
    grouping sets, and one sort that ranks stores and products.

    Department units are the sum of *rounded* store units while the chain rounds its raw
    total, as the published figures do. A product's description is the one on its earliest
    sale of the day."""
    sums = base.groupingSets([["day"], ["day", "dept", "store"], ["day", "dept", "code"]], "day", "dept", "store", "code").agg(
        F.grouping("dept").alias("_chain"), F.grouping("store").alias("_product"),
        round_even(F.sum("u"), 0).cast("bigint").alias("units"), F.sum("s").alias("sales"), F.min("first").alias("first"))
    level = F.when(F.col("_chain") == 1, "chain").when(F.col("_product") == 1, "dept_product").otherwise("dept_store")
    sums = sums.withColumn("level", level)
    # one sort for both rankings; a department's total rides on its best store's row
    group = Window.partitionBy("day", "level", "dept").orderBy(F.col("sales").desc(), "store", "code")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sums.withColumns({"rank": F.row_number().over(group), "all_units": F.sum("units").over(whole), "all_sales": F.sum("sales").over(whole)})
    ranked = ranked.filter((F.col("level") != "dept_product") | (F.col("rank") <= top_n))
    none = F.lit(None)
    row = lambda level, store, code, item, units, sales, rank: F.struct(
        level.alias("level"), "day", "dept", store.cast("string").alias("store"), code.cast("string").alias("code"), item.cast("string").alias("item"),
        units.alias("units"), sales.alias("sales"), rank.cast("bigint").alias("rank"))
    own = row(F.col("level"), F.col("store"), F.col("code"), F.when(F.col("level") == "dept_product", F.col("first.d")),
              F.col("units"), F.col("sales").cast(ranked.schema["all_sales"].dataType), F.when(F.col("level") != "chain", F.col("rank")))
    dept = row(F.lit("dept"), none, none, none, F.col("all_units"), F.col("all_sales"), none)
    head = (F.col("level") == "dept_store") & (F.col("rank") == 1)
    return ranked.select(F.inline(F.when(head, F.array(dept, own)).otherwise(F.array(own))))


def live_rollup(lines: DataFrame, mapping=None, top_n: int = TOP_PRODUCTS) -> DataFrame:
    """One pre-aggregation to (day, dept, store, code) does the per-line work (map-side
    partial aggregation); every level is rolled up from it."""
    return live_levels(live_base(lines, mapping), top_n)


def q_live_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_rollup(ctx(spark, sf_dir).sales_lines)


# ---- purchase orders ---------------------------------------------------------------------

# The chain drops these departments from the open-PO report, and these categories within
# Miscellaneous; the fixture maps its part types and brands onto them.
FIXTURE_PO_DROP_DEPTS = ["standard", "large", "small"]
FIXTURE_PO_MISC_DEPTS = ["promo"]
FIXTURE_PO_DROP_MISC_CATS = ["brand#1", "brand#2"]


def po_lines_clean(po: DataFrame) -> DataFrame:
    """Drop departments, and categories within misc; blank codes dropped."""
    d = F.lower(F.trim(F.coalesce(F.col("department"), F.lit(""))))
    c = F.lower(F.trim(F.coalesce(F.col("category"), F.lit(""))))
    keep = ~d.isin(FIXTURE_PO_DROP_DEPTS) & ~(d.isin(FIXTURE_PO_MISC_DEPTS) & c.isin(FIXTURE_PO_DROP_MISC_CATS))
    return po.filter((F.trim(F.coalesce(F.col("code"), F.lit(""))) != "") & keep)


def open_po_report(po: DataFrame, as_of: str = AS_OF, days: int = config.OPEN_PO_DAYS, team: str | None = None) -> DataFrame:
    """Lines still in Receiving, plus recently created lines (Receiving or
    Received) with a case discrepancy; each tagged with its source (bag union). ``team`` keeps the
    lines whose buying team contains that text, in any case."""
    if team:
        po = po.filter(F.contains(F.lower("team"), F.lit(team.lower())))
    cut = F.date_sub(F.lit(as_of).cast("date"), days)
    base = (po.withColumn("case_discrepancy", F.col("cases_ordered") - F.col("cases_received"))
              .filter(F.trim(F.coalesce(F.col("vendor"), F.lit(""))) != ""))
    receiving = base.filter(F.col("status") == "Receiving").withColumn("source", F.lit("Receiving"))
    disc = (base.filter(F.col("status").isin("Inventory Received", "Receiving")
                        & (F.col("case_discrepancy") != 0) & (F.col("created") > cut))
                .withColumn("source", F.lit("Discrepancy")))
    return po_lines_clean(receiving.unionByName(disc)).select(
        "source", "code", "vendor", "location", "ref", "status", "cases_ordered", "cases_received",
        "case_discrepancy", "department", "category", "created")


def vendor_split_manifest(po: DataFrame, as_of: str = AS_OF, days: int = config.VENDOR_PO_DAYS) -> DataFrame:
    """This week's Receiving lines per vendor -> (vendor, file, lines) sorted by vendor.
    Blank codes dropped, missing vendor -> 'Unknown'."""
    lines = _vendor_lines(po, as_of, days)
    return (lines.groupBy("vendor").agg(F.count("*").alias("lines"))
                 .withColumn("file", F.concat(safe_name(F.col("vendor")), F.lit(".csv")))
                 .select("vendor", "file", "lines").orderBy("vendor"))


def _vendor_lines(po: DataFrame, as_of: str, days: int) -> DataFrame:
    cut = F.date_sub(F.lit(as_of).cast("date"), days)
    return (po.filter((F.col("status") == "Receiving") & (F.col("created") > cut)
                      & (F.trim(F.coalesce(F.col("code"), F.lit(""))) != ""))
              .withColumn("vendor", F.coalesce(F.nullif(F.trim("vendor"), F.lit("")), F.lit("Unknown"))))


FILES_PER_VENDOR = 4         # at least, of a vendor with more than LINES_PER_FILE lines; others have one file
LINES_PER_FILE = 100_000
VENDORS_PER_TASK = 500


def write_vendor_split(po: DataFrame, out_dir: str, as_of: str = AS_OF, days: int = config.VENDOR_PO_DAYS) -> DataFrame:
    """S10 sink: one CSV folder per vendor (partitioned write, overwrite; a large vendor is several
    files) + the manifest. The work is in the files, so tasks follow the vendors, and each task moves its files into place itself."""
    lines = _vendor_lines(po, as_of, days).withColumn("vendor_file", safe_name(F.col("vendor"))).select(
        "vendor_file", "location", "ref", "code", "cases_ordered", "department", "category")
    sizes = write_table(lines.groupBy("vendor_file").agg(F.count("*").alias("n")), "vendor-sizes")
    n_files = F.greatest(F.lit(FILES_PER_VENDOR), F.ceil(F.col("n") / LINES_PER_FILE))
    large = sizes.filter(F.col("n") > LINES_PER_FILE).select("vendor_file", n_files.alias("n_files"))
    dealt = lines.join(large, "vendor_file", "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("ref", "code"), F.col("n_files")), F.lit(0)))
    vendors, files = sizes.agg(F.count("*"), F.sum(F.ceil(F.col("n") / LINES_PER_FILE))).first()
    tasks = max(1, -(-vendors // VENDORS_PER_TASK), files // FILES_PER_VENDOR if files and files > vendors else 1)
    (dealt.repartition(tasks, "vendor_file", "piece").drop("n_files", "piece").write.mode("overwrite").partitionBy("vendor_file")
          .option("header", True).option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(out_dir))
    return vendor_split_manifest(po, as_of, days)


def q_open_po_report(spark, sf_dir):
    return open_po_report(ctx(spark, sf_dir).po_lines)


def q_open_po_wine(spark, sf_dir):
    """Q18 of one buying team, as the chain pulls it."""
    return open_po_report(ctx(spark, sf_dir).po_lines, team="wine")


def q_sink_vendor_split(spark, sf_dir):
    return vendor_split_manifest(ctx(spark, sf_dir).po_lines)


def q_vendor_split_files(spark, sf_dir):
    """S10 end to end: the split written, read back, and counted per vendor folder."""
    import os
    import uuid
    from ..session import checkpoint_dir
    out = os.path.join(checkpoint_dir(spark), "vendor-split", uuid.uuid4().hex[:12])
    write_vendor_split(ctx(spark, sf_dir).po_lines, out)
    lines = spark.read.option("header", True).schema(
        "location string, ref bigint, code string, cases_ordered double, department string, category string, vendor_file string").csv(out)
    return lines.groupBy("vendor_file").agg(F.count("*").alias("lines"), F.sum("cases_ordered").alias("cases"),
                                            F.min("code").alias("first_code"))


def q_freshness(spark, sf_dir, as_of: str = AS_OF):
    """Q19: data date of the history feed, its age against the run date, health flag."""
    h = ctx(spark, sf_dir).history
    d = h.agg(F.max("day").alias("data_date"))
    age = staleness_days("data_date", F.lit(as_of).cast("date"))
    return d.select("data_date", F.lit(datetime.date.fromisoformat(as_of)).alias("as_of"),
                    age.alias("stale_days"), F.when(age >= 1, "stale").otherwise("ok").alias("health"))
