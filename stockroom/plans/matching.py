"""Catalog matching queries: uploaded price sheet compare (Q12) and the ad order (Q11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.codes import digits, norm_text, squeeze_lower
from ..functions.months import parse_months_token
from ..functions.numeric import round_even
from ..functions.text import expand_abbrev, expand_ad_line
from ..operators.matching import best_match, containment, tokens
from ..operators.rollups import dedupe_keep
from ..operators.windows import running_sum
from ..session import together, write_table
from ..sources.fixtures import AS_OF
from .base import ctx
from .brief import inventory_snapshot

_MONTH = int(AS_OF[5:7])
AD_DEPT = "thc"


# ---- Q12 sheet compare ----------------------------------------------------------------

def sheet_compare(upload: DataFrame, catalog: DataFrame, snapshot: DataFrame) -> DataFrame:
    """J12 + J13: match each uploaded row to the catalog by code digits (last listing wins),
    else by normalised name; attach live stock by name; cost gap and stock flags.

    The listings meet the stock and the names before the upload does, so an uploaded row is dealt out twice: by its code, and
    by its name. A row without the key of a join (no code, or its code was found) can hit nothing there and is spread by its
    hash, so that such rows are never one task's."""
    cat = catalog.select(digits("code").alias("ck"), squeeze_lower("item").alias("dk"), "item", "unit_cost", "price", "cat_row").filter(F.col("ck") != "")
    by_code = dedupe_keep(cat.drop("dk"), ["ck"], "cat_row", keep="last").select(
        "ck", F.col("item").alias("c_item"), F.col("unit_cost").alias("our_cost"), F.col("price").alias("our_retail"))
    by_desc = (dedupe_keep(cat.select("dk", "ck", "cat_row").filter(F.col("dk") != ""), ["dk"], "cat_row", keep="last")
               .select("dk", F.col("ck").alias("code2")))
    stock = dedupe_keep(snapshot.select(squeeze_lower("item").alias("sk"), F.col("chain_oh").alias("oh"), "wos",
                                        F.struct("dept", "item").alias("_ord")), ["sk"], "_ord", keep="last").drop("_ord")
    by_code = by_code.withColumn("_sk", F.when(F.col("c_item").isNotNull(), squeeze_lower("c_item")))
    listing = write_table(by_code.join(stock, F.col("_sk") == stock["sk"], "left").drop("_sk", "sk"), "compare-listings")
    named = by_desc.join(listing.select(F.col("ck").alias("code2"), *[F.col(c).alias(f"{c}2") for c in listing.columns if c != "ck"]), "code2")

    u = upload.withColumn("their_code", digits("up_code")).withColumn("dk", squeeze_lower("up_item"))
    apart = F.xxhash64("up_row", "up_item").cast("string")
    # digits hold no "-", and a squeezed name never two spaces
    u = u.withColumn("_ck", F.when(F.col("their_code") != "", F.col("their_code")).otherwise(F.concat(F.lit("-"), apart)))
    j = u.join(listing, F.col("_ck") == listing["ck"], "left").drop("ck", "_ck")
    asked = F.col("c_item").isNull() & (F.col("dk") != "")
    j = j.withColumn("_dk", F.when(asked, F.col("dk")).otherwise(F.concat(F.lit("  "), apart))).drop("dk")
    j = j.join(named, F.col("_dk") == named["dk"], "left")
    j = j.withColumn("upc", F.coalesce("code2", "their_code"))
    for c in ("c_item", "our_cost", "our_retail", "oh", "wos"):
        j = j.withColumn(c, F.coalesce(c, f"{c}2"))
    carry = F.col("c_item").isNotNull()
    vs = F.when(carry & F.col("up_price").isNotNull() & F.coalesce(F.col("our_cost") != 0, F.lit(False)),
                round_even((F.col("our_cost") - F.col("up_price")) / F.col("our_cost") * 100, 1))
    flag = (F.when(~carry, F.lit("we don't carry / not found"))
            .when(F.col("wos") < config.LOW_WOS, F.lit("LOW — restock"))
            .when(F.col("wos") > config.OVERSTOCK_WOS, F.lit("OVERSTOCK — skip")))
    their_item = F.when(F.coalesce(F.col("up_item"), F.lit("")) != "", F.col("up_item")) \
        .otherwise(F.coalesce(F.col("c_item"), F.lit("")))
    return j.select(
        "up_row", their_item.alias("their_item"), "upc", F.when(carry, "Yes").otherwise("No").alias("carry"),
        F.col("up_price").alias("their_price"),
        F.when(carry, F.col("our_cost")).alias("our_cost"), vs.alias("vs_cost_pct"),
        F.when(carry, F.col("our_retail")).alias("our_retail"),
        F.when(carry, F.col("oh")).alias("oh"), F.when(carry, F.col("wos")).alias("wos"), flag.alias("flag"))


def compare_summary(rows: DataFrame) -> DataFrame:
    """Q12 summary counts in one aggregate."""
    return rows.agg(F.count("*").alias("total"), F.count_if(F.col("carry") == "Yes").alias("matched"),
                    F.count_if(F.col("carry") == "No").alias("not_carried"),
                    F.count_if(F.col("vs_cost_pct") > 0).alias("cheaper_than_our_cost"),
                    F.count_if(F.col("flag").startswith("LOW")).alias("low_stock"),
                    F.count_if(F.col("flag").startswith("OVERSTOCK")).alias("overstock"))


# ---- Q11 ad order ------------------------------------------------------------------------

def ad_catalog(catalog: DataFrame, buy_months: DataFrame) -> DataFrame:
    """The buyer's full list: listing id, UPC digits, description, units/case, case prices,
    buy-month text ('m|m')."""
    bm = buy_months.groupBy("code_key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(F.col("m").cast("int"))), lambda m: m.cast("string")), "|")
         .alias("bm_text"))
    return (catalog.join(bm, "code_key", "left")
                   .select(F.col("cat_row").alias("cid"), digits("code").alias("upc"), F.col("item").alias("desc"),
                           norm_text("item").alias("nd"), F.col("case_pack").alias("units_case"),
                           (F.col("unit_cost") * F.col("case_pack")).alias("net_case"),
                           (F.col("price") * F.col("case_pack")).alias("retail_case"),
                           F.coalesce(F.col("bm_text"), F.lit("")).alias("bm_text")))


def _stock_rows(snapshot: DataFrame) -> DataFrame:
    """Inventory rows keyed by item, with the file's order (velocity desc, then item) as a
    sortable ``ord`` for first-wins ties - no global ranking pass."""
    return snapshot.select(F.col("item").alias("sid"), "chain_oh", "wk_velocity", "units_90d", "wos",
                           norm_text("item").alias("nd"),
                           F.struct((-F.col("wk_velocity")).alias("v"), F.col("item").alias("i")).alias("ord"))


def ad_parts(lines: DataFrame, dept: str) -> DataFrame:
    """The parts of the ad lines (F07) with the weeks of supply their kind is bought to."""
    tg = {**config.AD_TARGETS_DEFAULT, **config.AD_TARGETS.get(dept, {})}
    parts = lines.select("line_id", "raw", "kind", F.posexplode(expand_ad_line("raw")).alias("pi", "p")) \
        .select("line_id", "raw", "kind", "pi", F.col("p.q").alias("q"), F.col("p.is_brand").alias("is_brand"))
    return parts.withColumn("target", F.when(F.lower("kind") == "sunday", F.lit(tg["sunday"]))
                            .when(F.lower("kind") == "weekly", F.lit(tg["weekly"])).otherwise(F.lit(4.5)))


def match_singles(parts: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listing of each single item of the ad: UPC digits, exact name, or fuzzy tokens (J14); and the
    parts without one."""
    single = parts.filter(~F.col("is_brand")).withColumn("dig", digits("q")).withColumn("nq", norm_text("q"))
    by_upc = (catalog.filter(F.col("upc") != "").groupBy("upc").agg(F.max("cid").alias("u_cid")))
    s = single.join(by_upc.withColumnRenamed("upc", "dig"), "dig", "left") \
        .join(by_upc.select(F.col("upc").alias("_d2"), F.col("u_cid").alias("u2_cid")),
              F.regexp_replace("dig", "^0+", "") == F.col("_d2"), "left")
    s = s.withColumn("upc_cid", F.when(F.length("dig") >= 11, F.coalesce("u_cid", "u2_cid")))
    # listings that share a name score alike and the smallest id wins ties, so both the exact and the
    # fuzzy match run over distinct names (each carrying its smallest listing id)
    names = catalog.filter(F.col("nd") != "").groupBy("nd").agg(F.min("cid").alias("cid"))
    s = write_table(s.join(names.select(F.col("nd").alias("nq"), F.col("cid").alias("e_cid")), "nq", "left"), "ad-singles")
    q_tok = tokens(s.filter(F.col("upc_cid").isNull() & F.col("e_cid").isNull())
                    .withColumn("xq", expand_abbrev("nq")), ["line_id", "pi"], "xq")
    fz = best_match(q_tok, tokens(names, ["cid"], "nd"), ["line_id", "pi"], "cid", None,
                    min_score=config.AD_MATCH_MIN_SCORE).select("line_id", "pi", F.col("cid").alias("f_cid"))
    s = s.join(fz, ["line_id", "pi"], "left")
    s = s.withColumn("cid", F.coalesce("upc_cid", "e_cid", "f_cid")).withColumn(
        "conf", F.when(F.col("upc_cid").isNotNull(), "upc").when(F.col("e_cid").isNotNull(), "exact")
        .when(F.col("f_cid").isNotNull(), "fuzzy"))
    rows = s.filter(F.col("cid").isNotNull()).select(
        "line_id", "pi", F.lit(0).alias("bi"), "cid", "conf", "target", F.lit(False).alias("many"))
    return rows, s.filter(F.col("cid").isNull()).select("line_id", "pi", F.col("q").alias("unmatched"))


def match_brands(parts: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every listing of each whole brand of the ad (J15), numbered by id; and the parts without one."""
    # lines that name one brand expand alike, so each distinct set of tokens is matched once. A UPC
    # goes to the first line that lists it: of equal sets that is the first line; rows without a UPC
    # stay on every line
    toks = F.array_sort(F.filter(F.array_distinct(F.split(norm_text("q"), " ")), lambda x: F.length(x) >= 2))
    brand = parts.filter(F.col("is_brand")).withColumn("bk", F.array_join(toks, " "))
    b_tok = brand.filter(F.col("bk") != "").select("bk", F.explode(F.split("bk", " ")).alias("tok")).distinct()
    cat_tok = tokens(catalog.filter(F.col("nd") != ""), ["cid"], "nd")
    hits = containment(b_tok, cat_tok, ["bk"], "cid").join(catalog.select("cid", (F.col("upc") != "").alias("has_upc")), "cid")
    # numbered range by range: a brand word that a third of the catalog holds is not one task's
    numbered = running_sum(hits.withColumn("one", F.lit(1)), ["bk"], ["cid"], "one", "bi").drop("one")
    hits = write_table(numbered.withColumn("bi", F.col("bi").cast("int")), "ad-brand-hits")
    line = F.struct("line_id", "pi", "target")
    first = brand.groupBy("bk").agg(F.min(line).alias("l")).select("bk", "l.*")
    every = hits.filter("has_upc").join(first, "bk").unionByName(
        hits.filter("NOT has_upc").join(brand.select("bk", "line_id", "pi", "target"), "bk"))
    sizes = hits.groupBy("bk").agg(F.max("bi").alias("n"))
    rows = every.join(sizes, "bk").select("line_id", "pi", "bi", "cid", F.lit("brand").alias("conf"), "target",
                                          (F.col("n") > config.BRAND_REVIEW_COUNT).alias("many"))
    return rows, brand.join(sizes, "bk", "left_anti").select("line_id", "pi", F.col("raw").alias("unmatched"))


def ad_order(lines: DataFrame, catalog: DataFrame, snapshot: DataFrame, *, month: int = _MONTH,
             dept: str = AD_DEPT) -> tuple[DataFrame, DataFrame]:
    """Q11: expand ad lines (F07), match each part to the catalog - UPC digits, exact name,
    fuzzy prefix tokens (J14, score >= 0.6), or whole brand (J15) - then size the
    buy from live stock. Returns (rows, unmatched)."""
    parts, catalog, stock = together(lines.sparkSession, lambda: write_table(ad_parts(lines, dept), "ad-parts"),
                                     lambda: write_table(catalog, "ad-catalog"),
                                     lambda: write_table(_stock_rows(snapshot), "ad-stock"))
    (single_rows, single_miss), (brand_rows, brand_miss) = together(lines.sparkSession, lambda: match_singles(parts, catalog),
                                                                    lambda: match_brands(parts, catalog))
    # -- first occurrence of a UPC wins across all lines
    rows = single_rows.unionByName(brand_rows).join(catalog, "cid")
    place = F.struct("line_id", "pi", "bi")
    first = rows.filter(F.col("upc") != "").groupBy("upc").agg(F.min(place).alias("_first"))
    rows = (rows.join(first, "upc", "left")
                .filter(F.col("_first").isNull() | (place == F.col("_first"))).drop("_first"))
    # -- stock: exact name, else best token overlap with any score
    rows = write_table(rows, "ad-matched-rows")
    by_name = stock.groupBy("nd").agg(F.min_by("sid", "ord").alias("x_sid"))
    rows = rows.join(by_name, "nd", "left")
    need_fz = rows.filter(F.col("x_sid").isNull()).select("nd").distinct().withColumn("qid", F.col("nd"))
    s_fz = best_match(tokens(need_fz, ["qid"], "nd"), tokens(stock, ["sid"], "nd"), ["qid"], "sid",
                      stock.select("sid", "ord")) \
        .select(F.col("qid").alias("nd"), F.col("sid").alias("f_sid"))
    rows = rows.join(s_fz, "nd", "left").withColumn("sid", F.coalesce("x_sid", "f_sid"))
    rows = rows.join(stock.drop("nd", "ord"), "sid", "left")
    multi = catalog.filter(F.col("upc") != "").groupBy("nd").agg(F.countDistinct("upc").alias("n_upc"))
    rows = rows.join(multi, "nd", "left")
    has_inv = F.col("sid").isNotNull()
    oh = F.when(has_inv, F.coalesce("chain_oh", F.lit(0)).cast("double")).otherwise(F.lit(0.0))
    v30 = F.when(has_inv, F.coalesce("wk_velocity", F.lit(0.0))).otherwise(F.lit(0.0))
    v90 = F.when(has_inv, F.coalesce("units_90d", F.lit(0)) * 7.0 / 90.0).otherwise(F.lit(0.0))
    rows = rows.withColumn("oh", oh).withColumn("v30", v30).withColumn("v90", v90) \
        .withColumn("vel", F.when(F.col("v30") > 0, F.col("v30")).otherwise(F.col("v90")))
    cpk = F.when(F.col("units_case") != 0, F.col("units_case")).otherwise(F.lit(1.0))
    price = F.when(F.coalesce(F.col("net_case"), F.lit(0.0)) != 0, F.col("net_case")) \
        .otherwise(F.coalesce(F.col("retail_case"), F.lit(0.0)))
    need_u = F.greatest(F.col("target") * F.col("vel") - F.col("oh"), F.lit(0.0))
    cases = F.when(F.col("vel") > 0, F.when(need_u > 0, F.ceil(need_u / cpk)).otherwise(F.lit(0)).cast("bigint"))
    months = parse_months_token(F.col("bm_text"))
    flags = F.array(
        F.when(F.col("conf") == "brand", F.lit("whole brand")),
        F.when((F.col("conf") == "brand") & F.col("many"), F.lit("many, review")),
        F.when(F.col("conf") == "fuzzy", F.lit("check match")),
        F.when((F.col("conf") != "upc") & (F.coalesce(F.col("n_upc"), F.lit(0)) > 1), F.lit("multiple UPCs, confirm")),
        F.when(~has_inv, F.lit("no stock data")),
        F.when((F.col("vel") > 0) & (F.col("v30") <= 0) & (F.col("v90") > 0), F.lit("based on 90-day pace")),
        F.when(F.col("vel") <= 0, F.lit("no recent sales, set by hand")),
        F.when((F.col("bm_text") != "") & (F.size(months) > 0) & ~F.array_contains(months, F.lit(month)),
               F.concat(F.lit("not buy month ("), F.col("bm_text"), F.lit(")"))))
    wos = F.when(F.col("vel") > 0, F.col("oh") / F.col("vel")).otherwise(
        F.when(has_inv, F.coalesce(F.col("wos"), F.lit(0.0))).otherwise(F.lit(0.0)))
    out = rows.select(
        "line_id", "pi", "bi", F.col("upc"), F.trim(F.regexp_replace("desc", r"\s+", " ")).alias("item"),
        round_even(F.col("oh"), 0).cast("bigint").alias("on_hand"), round_even(F.col("vel"), 1).alias("wk_vel"),
        round_even(wos, 1).alias("wos"), F.col("target").alias("target_wos"), cases.alias("suggested_cases"),
        round_even(price, 2).alias("case_price"),
        round_even(F.coalesce(cases, F.lit(0)) * price, 2).alias("order_usd"),
        F.array_join(F.filter(flags, lambda x: x.isNotNull()), "; ").alias("flag"))
    unmatched = single_miss.unionByName(brand_miss)
    return out, unmatched


def q_sheet_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ctx(spark, sf_dir)
    return sheet_compare(t.upload, t.catalog, inventory_snapshot(t))


def q_sheet_compare_summary(spark, sf_dir):
    return compare_summary(q_sheet_compare(spark, sf_dir))


def _ad(spark, sf_dir):
    t = ctx(spark, sf_dir)
    return ad_order(t.ad_lines, ad_catalog(t.catalog, t.buy_months), inventory_snapshot(t))


def q_ad_order(spark, sf_dir):
    return _ad(spark, sf_dir)[0]


def q_ad_order_unmatched(spark, sf_dir):
    return _ad(spark, sf_dir)[1]
