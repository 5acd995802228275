"""Dashboard and list queries: product database, month-to-date KPIs, top sellers, low-margin
top sellers, needs-attention lists, focus retrieval, list explore with facets, budget levers
and the buyer decision state (A20, A21, A23, W04-W07, O01, O02, P08, Q13-Q16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.codes import norm_val
from ..functions.numeric import round_even
from ..functions.text import brand_of, keyword_score, potency_of, query_words
from ..operators.budget import fit_budget, right_size, right_size_candidates
from ..operators.decisions import decision_state
from ..operators.quantile import exact_quantile
from ..operators.rollups import first_by
from ..operators.trigrams import build, search
from ..operators.windows import top_n
from ..session import write_table
from .base import ctx, scoped_inventory, store_needs
from .brief import inventory_snapshot, pricing_flags, restock_actions
from .order import ranked_moves
from .weekly import weekly_order

# --- fixed values: dashboard defaults ---------------------------------------------------
TOP_SELLERS_N = 15
FOCUS_DEALS_N = 25
SHEET_BUDGET = 100000.0   # per-department budget used by the registered budget queries

# Parameters of the registered list / focus queries (a user passes their own).
FOCUS_QUESTION = "What does NATION_3 need this week - blue gear, cold anvil or a green widget?"
LIST_NEEDLE = "1 10MG"
LIST_QUERY = {"q": "gear", "filters": {"category": "brand#2"}, "exact": ["category"],
              "sort": "retail", "desc": True, "offset": 5, "limit": 40}


def with_dims(df: DataFrame, name: str) -> DataFrame:
    """Brand and potency parsed from the product name (the dashboard's filter dimensions)."""
    return df.withColumn("brand", brand_of(name)).withColumn("potency", potency_of(name))


def explore_filters(df: DataFrame, *, brands=None, potencies=None, min_discount: float = 0,
                    discount_col: str | None = None) -> DataFrame:
    """Multi-select brand and potency, minimum discount (non-numeric counts as 0)."""
    if brands:
        df = df.filter(F.col("brand").isin(list(brands)))
    if potencies:
        df = df.filter(F.col("potency").isin(list(potencies)))
    if min_discount > 0 and discount_col:
        df = df.filter(F.coalesce(F.col(discount_col).cast("string").try_cast("double"), F.lit(0.0)) >= min_discount)
    return df


def product_db(t) -> DataFrame:
    """Per department and product: month-to-date units (the 30-day window ends on the
    month's last day), median retail and cost (> 0 only), revenue, profit, margin and the
    number of stores out of stock. One aggregation over the store-level snapshot."""
    g = scoped_inventory(t).groupBy("dept", "item").agg(
        first_by("category").alias("category"),
        F.sum("u30").alias("units"),
        F.median(F.when(F.col("price_raw") > 0, F.col("price_raw"))).alias("retail"),
        F.median(F.when(F.col("cost") > 0, F.col("cost"))).alias("cost"),
        F.count_if(F.col("on_hand") <= 0).alias("stores_out"))
    margin = F.when((F.col("retail") > 0) & F.col("cost").isNotNull(),
                    round_even((F.col("retail") - F.col("cost")) / F.col("retail") * 100, 1))
    return with_dims(g.select(
        "dept", "item", "category", F.col("units").cast("bigint").alias("units"),
        round_even(F.col("retail"), 2).alias("retail"), round_even(F.col("cost"), 2).alias("cost"),
        margin.alias("margin_pct"),
        round_even(F.col("units") * F.col("retail"), 2).alias("revenue"),
        round_even(F.col("units") * (F.col("retail") - F.col("cost")), 2).alias("profit"),
        "stores_out"), "item")


def mtd_kpis(db: DataFrame) -> DataFrame:
    """Per department items, items short somewhere, revenue and profit this month."""
    return db.groupBy("dept").agg(
        F.count("*").alias("items"), F.count_if(F.col("stores_out") > 0).alias("short_somewhere"),
        round_even(F.sum("revenue"), 2).alias("revenue"), round_even(F.sum("profit"), 2).alias("profit"))


def category_sales(db: DataFrame) -> DataFrame:
    """Units by department and category."""
    return db.groupBy("dept", "category").agg(F.sum("units").alias("units"))


def low_margin_top_sellers(db: DataFrame, *, q: float = config.TOP_SELLER_QUANTILE,
                           low_margin: float = config.LOW_MARGIN_PCT) -> DataFrame:
    """Per department, sellers (units > 0) at or above the exact 70th percentile
    of units whose margin is under 45 %."""
    sells = db.filter(F.col("units") > 0)
    cut = exact_quantile(sells, "units", q, ["dept"], out="volume_cut")
    return (sells.join(cut, "dept")
                 .filter((F.col("units") >= F.col("volume_cut")) & (F.col("margin_pct") < low_margin))
                 .select("dept", "item", "brand", "potency", "category", "units", "margin_pct", "revenue",
                         "profit", "volume_cut"))


def top_sellers(db: DataFrame, metric: str, n: int = TOP_SELLERS_N) -> DataFrame:
    """The n best products per department by ``metric`` (product name breaks ties)."""
    return top_n(db, ["dept"], [F.col(metric).desc_nulls_last(), F.col("item")], n).select(
        "dept", "rank", "item", "category", metric)


def focus_lists(snapshot: DataFrame, question: str) -> dict[str, DataFrame]:
    """Q13: per department - at-risk items (WOS <= 2) and active deals by weekly velocity,
    and the items whose names contain the most question words."""
    low = top_n(snapshot.filter(F.col("wos") <= config.FOCUS_LOW_WOS), ["dept"],
                [F.col("wk_velocity").desc(), F.col("item")], config.FOCUS_TOP_N)
    deals = top_n(snapshot.filter(F.trim(F.col("deal")) != ""), ["dept"],
                  [F.col("wk_velocity").desc(), F.col("item")], FOCUS_DEALS_N)
    words = query_words(question)
    scored = snapshot.withColumn("score", keyword_score(F.col("item"), words)).filter(F.col("score") > 0)
    items = top_n(scored, ["dept"], [F.col("score").desc(), F.col("item")], config.FOCUS_TOP_N)
    cols = ["dept", "rank", "item", "category", "chain_oh", "wk_velocity", "wos", "cost", "retail", "margin_pct", "deal"]
    return {"low": low.select(*cols), "deals": deals.select(*cols), "items": items.select(*cols, "score")}


def focus_store_detail(moves: DataFrame, question: str) -> DataFrame:
    """Q13: transfer lines of every store named in the question, each in its transfer-plan order."""
    q = F.lit((question or "").lower())
    named = moves.filter(F.instr(q, F.lower(F.col("to_store"))) > 0)
    w = Window.partitionBy("to_store").orderBy(F.col("priority_rank"), F.col("value").desc_nulls_last(),
                                               F.col("dept"), F.col("item"))
    return named.withColumn("line", F.row_number().over(w))


# ---- O01 / O02 / A21 list explore --------------------------------------------------------

def _search(df: DataFrame, cols: list[str], q: str, index=None) -> DataFrame:
    return search(df, cols, q, index)


def facets(df: DataFrame, cols: list[str], *, lo: int = config.FACET_MIN_VALUES,
           hi: int = config.FACET_MAX_VALUES) -> DataFrame:
    """Per column the distinct values merged across case/spacing variants (shown in
    their most frequent spelling; smallest spelling on equal counts), for columns with
    2-50 such values. One unpivot + two aggregations over the whole tab."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                     F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias("v"))
                                            for c in cols])).alias("s")).select("s.column", "s.v")
    stacked = stacked.filter((F.col("v") != "") & (F.lower("v") != "nan"))
    counts = stacked.groupBy("column", norm_val(F.col("v")).alias("k"), "v").agg(F.count("*").alias("n"))
    labels = counts.groupBy("column", "k").agg(
        F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))).alias("label"))
    # label counts per column are aggregated, not windowed: a free-text column can have
    # millions of labels and must not land in one task just to be discarded
    sizes = (labels.groupBy("column").agg(F.count("*").alias("n_labels"))
                   .filter((F.col("n_labels") >= lo) & (F.col("n_labels") <= hi)))
    return labels.join(sizes, "column").select("column", "label", "n_labels")


def _numeric_key(c: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[$,%\s]", "").try_cast("double")


def list_explore(tab: DataFrame, cols: list[str], *, q: str = "", filters: dict | None = None,
                 exact: list[str] | tuple = (), sort: str | None = None, desc: bool = False,
                 offset: int = 0, limit: int = 400, row_id: str = "row_id", index=None) -> DataFrame:
    """O01 + O02: search every column of the whole tab, apply per-column filters (exact after
    case/space normalising, else case-insensitive substring), sort the whole matched set -
    numerically when >= 60 % of the sort column parses as a number after stripping $ , %
    and spaces (blanks last), else case-insensitively - then page. Every row carries the
    tab total and the matched count; ties keep tab order. With a text ``index`` of the tab (``trigrams.build``) a
    search reads the rows that may match; the total is then the index's."""
    df = _search(tab, cols, q, index)
    for c, val in (filters or {}).items():
        if c in cols and str(val) != "":
            if c in exact:
                df = df.filter(norm_val(F.trim(F.col(c))) == norm_val(F.lit(str(val))))
            else:
                df = df.filter(F.instr(F.lower(F.col(c).cast("string")), F.lit(str(val).lower())) > 0)
    # the counts and the numeric share are scalars of the response, from one aggregate over the matched rows
    numeric = F.avg(_numeric_key(sort).isNotNull().cast("double")) if sort and sort in cols else F.lit(None).cast("double")
    matched, share = df.agg(F.count("*"), numeric).first()
    total = tab.count() if index is None else index.rows
    order = []
    if sort and sort in cols:
        if share is not None and share >= config.NUMERIC_SORT_SHARE:
            k = _numeric_key(sort)
            order = [k.desc_nulls_last() if desc else k.asc_nulls_last()]
        else:
            k = F.lower(F.col(sort).cast("string"))
            order = [k.desc() if desc else k.asc()]
    page = df.orderBy(*order, F.col(row_id)).offset(offset).limit(limit)
    return page.withColumn("total", F.lit(total)).withColumn("matched", F.lit(matched))


# ---- registered queries ------------------------------------------------------------------

def q_mtd_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtd_kpis(product_db(ctx(spark, sf_dir)))


def q_category_sales(spark, sf_dir):
    return category_sales(product_db(ctx(spark, sf_dir)))


def q_low_margin_top_sellers(spark, sf_dir):
    return low_margin_top_sellers(write_table(product_db(ctx(spark, sf_dir)), "product-db"))


def q_top_sellers(spark, sf_dir):
    return top_sellers(product_db(ctx(spark, sf_dir)), "units")


def q_top_profit(spark, sf_dir):
    return top_sellers(product_db(ctx(spark, sf_dir)), "profit")


def q_needs_attention_stockouts(spark, sf_dir):
    """Q16: stockouts on sellers, largest weekly $ at risk first."""
    r = with_dims(restock_actions(ctx(spark, sf_dir)), "item")
    return explore_filters(r, discount_col="discount_pct").filter(F.col("stockout") == "STOCKOUT").select(
        "dept", "item", "brand", "potency", "store", "on_hand", "wk_velocity", "trend", "wk_usd_at_risk", "action")


def q_needs_attention_above_market(spark, sf_dir):
    """Q16: items priced above the market benchmark, largest gap first."""
    p = with_dims(pricing_flags(ctx(spark, sf_dir)), "item")
    return explore_filters(p).filter(F.col("flag").startswith("ABOVE")).select(
        "dept", "item", "brand", "potency", "our_price", "market_price", "vs", "gap_pct")


def _focus(spark, sf_dir, part):
    return focus_lists(inventory_snapshot(ctx(spark, sf_dir)), FOCUS_QUESTION)[part]


def q_focus_low_wos(spark, sf_dir):
    return _focus(spark, sf_dir, "low")


def q_focus_deals(spark, sf_dir):
    return _focus(spark, sf_dir, "deals")


def q_focus_items(spark, sf_dir):
    return _focus(spark, sf_dir, "items")


def q_focus_store_detail(spark, sf_dir):
    return focus_store_detail(ranked_moves(ctx(spark, sf_dir)), FOCUS_QUESTION)


TAB_COLS = ["upc", "description", "department", "category", "supplier", "units_case", "retail"]


def q_list_explore(spark, sf_dir):
    t = ctx(spark, sf_dir)
    return list_explore(t.explore_tab, TAB_COLS, **LIST_QUERY)


def tab_index(t):
    """The text index of the list tab, built once per session."""
    return t.derived("explore-tab-index", lambda t: build(t.explore_tab, TAB_COLS, "row_id"))


def q_list_explore_indexed(spark, sf_dir):
    """O01 through the text index of the tab: the same page."""
    t = ctx(spark, sf_dir)
    return list_explore(t.explore_tab, TAB_COLS, **LIST_QUERY, index=tab_index(t))


def q_list_search(spark, sf_dir):
    """Every row of the tab that holds a rare text, through the index."""
    t = ctx(spark, sf_dir)
    return search(t.explore_tab, TAB_COLS, LIST_NEEDLE, tab_index(t)).select("row_id", "upc", "description")


def q_list_facets(spark, sf_dir):
    t = ctx(spark, sf_dir)
    return facets(_search(t.explore_tab, TAB_COLS, LIST_QUERY["q"]), TAB_COLS)


def _sheet(spark, sf_dir):
    t = ctx(spark, sf_dir)
    return weekly_order(store_needs(t), t).filter(F.col("section") == "order")


def q_fit_budget(spark, sf_dir):
    return fit_budget(_sheet(spark, sf_dir), SHEET_BUDGET)


def q_right_size(spark, sf_dir):
    return right_size(_sheet(spark, sf_dir), SHEET_BUDGET)


def q_right_size_candidates(spark, sf_dir):
    return right_size_candidates(_sheet(spark, sf_dir))


def q_decision_state(spark, sf_dir):
    return decision_state(ctx(spark, sf_dir).change_log)
