"""Oracle SQL: dashboard lists, focus retrieval, list explore, budget levers, decision state."""

from stockroom import config
from stockroom.functions.text import query_words
from stockroom.plans import explore as X

from . import brief, order, weekly
from .common import INV, with_views


def brand_sql(c: str) -> str:
    toks = f"string_split_regex(trim(coalesce({c}, '')), '\\s+')"
    key = f"regexp_replace(regexp_replace(lower({toks}[1]), '^[''s]+', ''), '[''s]+$', '')"
    two = ", ".join(f"'{w}'" for w in config.TWO_WORD_BRANDS)
    return (f"CASE WHEN {toks}[1] = '' THEN '' WHEN {key} IN ({two}) AND len({toks}) > 1 "
            f"THEN {toks}[1] || ' ' || {toks}[2] ELSE {toks}[1] END")


def potency_sql(c: str) -> str:
    s = f"regexp_extract(coalesce({c}, ''), '(\\d+)\\s?mg', 1, 'i')"
    return f"CASE WHEN {s} <> '' THEN CAST({s} AS BIGINT) END"


def norm_val_sql(c: str) -> str:
    return f"regexp_replace(lower(coalesce(CAST({c} AS VARCHAR), '')), '\\s+', '', 'g')"


DB = f"""db0 AS (
  SELECT dept, item, arg_min(category, ingest_row) FILTER (WHERE category IS NOT NULL) AS category,
         sum(u30) AS units, median(CASE WHEN price_raw > 0 THEN price_raw END) AS retail,
         median(CASE WHEN cost > 0 THEN cost END) AS cost, count(*) FILTER (WHERE on_hand <= 0) AS stores_out
  FROM sinv GROUP BY dept, item),
db AS (
  SELECT dept, item, category, CAST(trunc(units) AS BIGINT) AS units, round_even(retail, 2) + 0.0 AS retail,
         round_even(cost, 2) + 0.0 AS cost,
         CASE WHEN retail > 0 AND cost IS NOT NULL THEN round_even((retail - cost) / retail * 100, 1) + 0.0 END AS margin_pct,
         round_even(units * retail, 2) + 0.0 AS revenue, round_even(units * (retail - cost), 2) + 0.0 AS profit,
         stores_out, {brand_sql('item')} AS brand, {potency_sql('item')} AS potency
  FROM db0)"""

_DBH = with_views(["inventory"], INV, DB)

SQL = {}
SQL["mtd_kpis"] = _DBH + """
SELECT dept, count(*) AS items, count(*) FILTER (WHERE stores_out > 0) AS short_somewhere,
       round_even(sum(revenue), 2) + 0.0 AS revenue, round_even(sum(profit), 2) + 0.0 AS profit
FROM db GROUP BY dept"""

SQL["category_sales"] = _DBH + """
SELECT dept, category, CAST(sum(units) AS BIGINT) AS units FROM db GROUP BY dept, category"""

SQL["low_margin_top_sellers"] = _DBH + f""",
cut AS (SELECT dept, quantile_cont(CAST(units AS DOUBLE), {config.TOP_SELLER_QUANTILE}) AS volume_cut
        FROM db WHERE units > 0 GROUP BY dept)
SELECT db.dept, item, brand, potency, category, units, margin_pct, revenue, profit, volume_cut
FROM db JOIN cut ON cut.dept = db.dept
WHERE units > 0 AND units >= volume_cut AND margin_pct < {config.LOW_MARGIN_PCT}"""

for _key, _metric in (("top_sellers", "units"), ("top_profit", "profit")):
    SQL[_key] = _DBH + f"""
SELECT dept, rank, item, category, {_metric} FROM (
  SELECT *, row_number() OVER (PARTITION BY dept ORDER BY {_metric} DESC NULLS LAST, item) AS rank FROM db) x
WHERE rank <= {X.TOP_SELLERS_N}"""

SQL["needs_attention_stockouts"] = f"""
SELECT dept, item, {brand_sql('item')} AS brand, {potency_sql('item')} AS potency, store, on_hand, wk_velocity, trend,
       wk_usd_at_risk, action
FROM ({brief.SQL['restock_brief']}) r WHERE stockout = 'STOCKOUT'"""

SQL["needs_attention_above_market"] = f"""
SELECT dept, item, {brand_sql('item')} AS brand, {potency_sql('item')} AS potency, our_price, market_price, vs, gap_pct
FROM ({brief.SQL['pricing_flags']}) p WHERE starts_with(flag, 'ABOVE')"""

_SNAP = f"snap AS (SELECT * FROM ({brief.SQL['inventory_snapshot']}) s0)"
_FCOLS = "dept, rank, item, category, chain_oh, wk_velocity, wos, cost, retail, margin_pct, deal"
_SCORE = " + ".join(f"CASE WHEN instr(lower(item), '{w}') > 0 THEN 1 ELSE 0 END"
                    for w in query_words(X.FOCUS_QUESTION)) or "0"

SQL["focus_low_wos"] = f"""WITH {_SNAP}
SELECT {_FCOLS} FROM (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY wk_velocity DESC, item) AS rank
                      FROM snap WHERE wos <= {config.FOCUS_LOW_WOS}) x WHERE rank <= {config.FOCUS_TOP_N}"""

SQL["focus_deals"] = f"""WITH {_SNAP}
SELECT {_FCOLS} FROM (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY wk_velocity DESC, item) AS rank
                      FROM snap WHERE trim(deal) <> '') x WHERE rank <= {X.FOCUS_DEALS_N}"""

SQL["focus_items"] = f"""WITH {_SNAP},
sc AS (SELECT *, {_SCORE} AS score FROM snap)
SELECT {_FCOLS}, score FROM (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY score DESC, item) AS rank
                             FROM sc WHERE score > 0) x WHERE rank <= {config.FOCUS_TOP_N}"""

_Q = X.FOCUS_QUESTION.lower().replace("'", "''")
SQL["focus_store_detail"] = f"""WITH ranked AS (SELECT * FROM ({order.SQL['transfer_plan_ranked']}) r0),
named AS (SELECT * FROM ranked WHERE instr('{_Q}', lower(to_store)) > 0)
SELECT n.*, row_number() OVER (PARTITION BY n.to_store ORDER BY priority_rank, value DESC NULLS LAST, dept, item) AS line
FROM named n"""

_TAB = X.TAB_COLS
_HAY = "lower(concat_ws(' ', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _TAB) + "))"
_LQ = X.LIST_QUERY
_SEARCH = f"searched AS (SELECT * FROM explore_tab WHERE instr({_HAY}, '{_LQ['q'].lower()}') > 0)"
_FILTERS = " AND ".join(
    (f"{norm_val_sql(f'trim({c})')} = {norm_val_sql(repr(str(v)))}" if c in _LQ["exact"]
     else f"instr(lower(CAST({c} AS VARCHAR)), '{str(v).lower()}') > 0")
    for c, v in _LQ["filters"].items()) or "TRUE"
_NUM = f"TRY_CAST(regexp_replace(coalesce(CAST({_LQ['sort']} AS VARCHAR), ''), '[$,%\\s]', '', 'g') AS DOUBLE)"
_DIR = "DESC" if _LQ["desc"] else "ASC"

SQL["list_explore"] = with_views(["explore_tab"], _SEARCH) + f""",
filtered AS (SELECT * FROM searched WHERE {_FILTERS}),
share AS (SELECT avg(CASE WHEN {_NUM} IS NOT NULL THEN 1.0 ELSE 0.0 END) AS s FROM filtered)
SELECT {", ".join(["row_id"] + _TAB)}, (SELECT count(*) FROM explore_tab) AS total,
       (SELECT count(*) FROM filtered) AS matched
FROM filtered
ORDER BY CASE WHEN (SELECT s FROM share) >= {config.NUMERIC_SORT_SHARE} THEN {_NUM} END {_DIR} NULLS LAST,
         CASE WHEN (SELECT s FROM share) < {config.NUMERIC_SORT_SHARE} THEN lower(CAST({_LQ['sort']} AS VARCHAR)) END {_DIR},
         row_id
LIMIT {_LQ['limit']} OFFSET {_LQ['offset']}"""

SQL["list_explore_indexed"] = SQL["list_explore"]
SQL["list_search"] = with_views(["explore_tab"]) + f"""
SELECT row_id, upc, description FROM explore_tab WHERE instr({_HAY}, '{X.LIST_NEEDLE.lower()}') > 0"""

_UNPIVOT = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", trim(coalesce(CAST({c} AS VARCHAR), '')) AS v FROM searched"
                              for c in _TAB)
SQL["list_facets"] = with_views(["explore_tab"], _SEARCH) + f""",
st AS (SELECT * FROM ({_UNPIVOT}) u WHERE v <> '' AND lower(v) <> 'nan'),
cn AS (SELECT "column", {norm_val_sql('v')} AS k, v, count(*) AS n FROM st GROUP BY 1, 2, 3),
lb AS (SELECT "column", k, arg_min(v, (-n, v)) AS label FROM cn GROUP BY 1, 2),
nl AS (SELECT *, count(*) OVER (PARTITION BY "column") AS n_labels FROM lb)
SELECT "column", label, n_labels FROM nl
WHERE n_labels >= {config.FACET_MIN_VALUES} AND n_labels <= {config.FACET_MAX_VALUES}"""

_SHEET = weekly._HEAD + """,
sheet AS (SELECT * FROM lines WHERE section = 'order')"""

SQL["fit_budget"] = _SHEET + f""",
r AS (SELECT dept, item, wos, net_buy_usd, coalesce(CAST(wos AS DOUBLE), 0.0) AS w,
             coalesce(CAST(net_buy_usd AS DOUBLE), 0.0) AS net FROM sheet),
tot AS (SELECT dept, sum(net) AS sheet_total FROM r GROUP BY dept),
fwalk AS (SELECT r.*, coalesce(sum(net) OVER (PARTITION BY dept ORDER BY w DESC, net DESC, item
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cut_before
         FROM r WHERE net > 0)
SELECT fwalk.dept, item, wos, net_buy_usd, sheet_total, cut_before FROM fwalk JOIN tot ON tot.dept = fwalk.dept
WHERE sheet_total - cut_before > {X.SHEET_BUDGET}"""

_RS = _SHEET + f""",
rs0 AS (SELECT dept, item, wos, buy_cases, deal_terms, coalesce(CAST(chain_oh AS DOUBLE), 0.0) AS oh,
               coalesce(CAST(wos AS DOUBLE), 0.0) AS w, coalesce(CAST(buy_cases AS DOUBLE), 0.0) AS bc,
               coalesce(CAST(buy_units AS DOUBLE), 0.0) AS bu, coalesce(CAST(unit_cost AS DOUBLE), 0.0) AS cost FROM sheet),
rs1 AS (SELECT *, CASE WHEN bu > 0 AND bc > 0 THEN bu / bc ELSE 1.0 END AS cp,
               CASE WHEN w > 0 AND oh > 0 THEN oh / w ELSE 0.0 END AS vel FROM rs0),
rs2 AS (SELECT *, greatest(0.0, CAST(ceil(greatest(0.0, 2.0 * vel - oh) / cp) AS DOUBLE)) AS lean_cases
        FROM rs1 WHERE bc >= 1 AND vel > 0),
cand AS (SELECT *, bc - lean_cases AS room, cp * cost AS percase,
                contains(upper(coalesce(deal_terms, '')), 'ON AD') AS on_ad FROM rs2 WHERE bc - lean_cases >= 1)"""

SQL["right_size_candidates"] = _RS + """
SELECT dept, item, wos, buy_cases, lean_cases, room * percase AS max_freed, on_ad FROM cand"""

SQL["right_size"] = _RS + f""",
gap AS (SELECT dept, sum(bu * cost) - {X.SHEET_BUDGET} AS gap FROM rs0 GROUP BY dept),
rwalk AS (SELECT cand.*, coalesce(sum(room * percase) OVER (PARTITION BY dept ORDER BY on_ad, w DESC, percase DESC, item
                                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS freed_before
         FROM cand),
w2 AS (SELECT rwalk.*, g.gap FROM rwalk JOIN gap g ON g.dept = rwalk.dept WHERE g.gap > 0 AND freed_before < g.gap),
w3 AS (SELECT *, CASE WHEN percase > 0 THEN least(room, CAST(ceil((gap - freed_before) / percase) AS DOUBLE))
                      ELSE room END AS trim_cases FROM w2)
SELECT dept, item, wos, buy_cases, bc - trim_cases AS new_cases, trim_cases * percase AS saved, on_ad FROM w3"""

_SETS = "('approve', 'qty', 'skip', 'fix')"
SQL["decision_state"] = with_views(["change_log"]) + f""",
sets AS (SELECT id, ts, dept, item, action, qty, note FROM change_log WHERE action IN {_SETS}),
u0 AS (SELECT target_id, min(id) AS undo_id FROM change_log WHERE action = 'undo' AND target_id IS NOT NULL GROUP BY target_id),
undos AS (SELECT u0.undo_id AS id, c.ts, s.dept, s.item, s.prev_action AS action, s.prev_qty AS qty, s.prev_note AS note
          FROM u0 JOIN change_log s ON s.id = u0.target_id AND s.action IN {_SETS}
          JOIN change_log c ON c.id = u0.undo_id),
e AS (SELECT * FROM sets UNION ALL SELECT * FROM undos),
lst AS (SELECT lower(trim(dept)) AS dk, lower(trim(item)) AS ik, max(id) AS id FROM e GROUP BY 1, 2)
SELECT e.dept, e.item, e.action, e.qty, e.note, e.id AS set_by, e.ts
FROM e JOIN lst ON lst.id = e.id WHERE e.action IS NOT NULL"""

# Streams: the streamed tables must equal the batch results.
from . import sales as _sales  # noqa: E402

SQL["stream_live_sales"] = _sales.SQL["live_rollup"]
SQL["stream_live_lines"] = with_views(["sales_lines"]) + """
SELECT CAST(timezone('America/Chicago', timezone('UTC', ts)) AS DATE) AS day, count(*) AS lines,
       CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(total) AS DECIMAL(28,2)) AS sales
FROM sales_lines WHERE trim(coalesce(code, '')) <> '' GROUP BY 1"""
SQL["stream_history"] = """
SELECT CAST(l_shipdate AS DATE) AS day, CAST(900000000000 + l_partkey AS VARCHAR) AS code, arg_min(p_brand, l_orderkey * 8 + l_linenumber) AS category,
       arg_min(p_name, l_orderkey * 8 + l_linenumber) AS item, sum(l_quantity) AS units,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue,
       CAST(sum(l_orderkey % 50) AS DOUBLE) AS on_hand, count(*) AS lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
SQL["ledger_history"] = SQL["stream_history"].replace("CAST(l_shipdate AS DATE) AS day", "CAST(date_trunc('week', l_shipdate) AS DATE) AS day")
SQL["stream_decisions"] = SQL["decision_state"]
SQL["stream_decision_refusals"] = with_views(["change_log"]) + f""",
u AS (SELECT id, target_id, min(id) OVER (PARTITION BY target_id) AS first FROM change_log WHERE action = 'undo' AND target_id IS NOT NULL)
SELECT u.id AS undo_id, u.target_id, lower(trim(s.dept)) AS dept_key, lower(trim(s.item)) AS item_key
FROM u JOIN change_log s ON s.id = u.target_id AND s.action IN {_SETS} WHERE u.id > u.first"""
SQL["stream_live_days"] = _sales.SQL["live_rollup"].split(",\nbase AS")[0] + """,
closed AS (SELECT max(timezone('America/Chicago', timezone('UTC', ts))) - INTERVAL 1 DAY AS upto FROM l)
SELECT day, dept, trim(store) AS store, trim(code) AS code, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(total) AS DECIMAL(28,2)) AS sales,
       arg_min(trim(description), (ts, event_id)) AS item, count(*) AS lines
FROM l, closed WHERE day + INTERVAL 1 DAY <= upto GROUP BY 1, 2, 3, 4"""
