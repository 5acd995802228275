"""Oracle SQL: weekly order (Q02) and its outputs."""

from .common import INV, NEED, TRANSFER, with_views

_VIEWS = ["inventory", "par_list", "ad_list", "buy_months", "deals", "remove_list", "new_list"]
_CUR = 6  # month of the snapshot date

ORDER = f"""roll AS (
  SELECT dept, item,
         arg_min(code, ingest_row) FILTER (WHERE code IS NOT NULL) AS code,
         arg_min(code_key, ingest_row) FILTER (WHERE code_key IS NOT NULL) AS code_key,
         arg_min(category, ingest_row) FILTER (WHERE category IS NOT NULL) AS category,
         arg_min(supplier, ingest_row) FILTER (WHERE supplier IS NOT NULL) AS supplier,
         sum(on_hand) AS chain_oh, sum(u30) AS u30, sum(u90) AS u90, sum(u_ly4) AS u_ly4,
         median(cost) AS cost, max(case_pack) AS case_pack, bool_or(has_par) AS has_par
  FROM needs GROUP BY dept, item),
g1 AS (
  SELECT r.*, CASE WHEN case_pack IS NULL OR case_pack = 0 THEN 1.0 ELSE case_pack END AS pack,
         u30 * 7 / 30 AS wk_vel,
         CASE WHEN u30 * 7 / 30 > 0 THEN round_even(chain_oh / (u30 * 7 / 30), 1) + 0.0 END AS wos,
         CASE WHEN u90 * 7 / 90 > 0 THEN round_even(((u30 * 7 / 30) / (u90 * 7 / 90) - 1) * 100, 0) + 0.0 END AS trend,
         round_even(u_ly4 / 4.0, 1) + 0.0 AS ly_wk,
         CAST(coalesce(t.gross_need, 0) AS DOUBLE) AS gross_need, CAST(coalesce(t.transfer, 0) AS DOUBLE) AS transfer,
         CAST(coalesce(t.net_buy, 0) AS DOUBLE) AS net_buy0
  FROM roll r LEFT JOIN titems t ON t.dept = r.dept AND t.item = r.item),
g2 AS (
  SELECT g1.*, round_even(net_buy0 / pack, 0) + 0.0 AS cases0 FROM g1),
g3 AS (
  SELECT g2.*, CAST(trunc(cases0 * pack) AS BIGINT) AS units0,
         a.kind AS ad_kind, a.target_wos AS ad_target,
         coalesce(a.kind IS NOT NULL AND length(a.kind) > 0, false) AS on_ad,
         greatest(a.target_wos * wk_vel - greatest(chain_oh, 0), 0) AS ad_units
  FROM g2 LEFT JOIN ad_list a ON a.code_key = g2.code_key),
g4 AS (
  SELECT g3.*, CASE WHEN on_ad AND ad_units > net_buy0 THEN ad_units ELSE net_buy0 END AS net_buy1 FROM g3),
g5 AS (
  SELECT g4.*, CASE WHEN on_ad THEN CAST(ceil(coalesce(net_buy1 / pack, 0)) AS DOUBLE) ELSE cases0 END AS cases1 FROM g4),
g6 AS (
  SELECT g5.*, CASE WHEN on_ad THEN CAST(trunc(cases1 * pack) AS BIGINT) ELSE units0 END AS units1 FROM g5),
bm AS (
  SELECT code_key, bool_or(m = {_CUR}) AS has_cur,
         min(CASE WHEN ((m - {_CUR}) % 12 + 12) % 12 <> 0 THEN ((m - {_CUR}) % 12 + 12) % 12 END) AS gap,
         string_agg(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][m], ', ' ORDER BY m) AS mtxt
  FROM (SELECT DISTINCT code_key, m FROM buy_months) GROUP BY code_key),
g7 AS (
  SELECT g6.*, bm.mtxt, coalesce(bm.has_cur, false) AS in_month,
         CASE WHEN bm.has_cur THEN least(coalesce(bm.gap, 12) * 4.345, 52.0) ELSE 0.0 END AS bm_wks
  FROM g6 LEFT JOIN bm ON bm.code_key = g6.code_key),
g8 AS (
  SELECT g7.*, bm_wks > 0 AS bm_stock,
         CASE WHEN bm_wks > 0 AND greatest(bm_wks * wk_vel - greatest(chain_oh, 0), 0) > net_buy1
              THEN greatest(bm_wks * wk_vel - greatest(chain_oh, 0), 0) ELSE net_buy1 END AS net_buy2
  FROM g7),
g9 AS (
  SELECT g8.*, CASE WHEN bm_stock THEN CAST(ceil(coalesce(net_buy2 / pack, 0)) AS DOUBLE) ELSE cases1 END AS cases2 FROM g8),
g10 AS (
  SELECT g9.*, CASE WHEN bm_stock THEN CAST(trunc(cases2 * pack) AS BIGINT) ELSE units1 END AS units2 FROM g9),
g11 AS (
  SELECT g10.*, coalesce(wos >= 4, false) AND NOT has_par AND NOT on_ad AND NOT bm_stock AS enough FROM g10),
g12 AS (
  SELECT g11.*,
         CASE WHEN enough THEN 0.0 ELSE cases2 END AS buy_cases,
         CASE WHEN enough THEN 0 ELSE units2 END AS buy_units,
         CASE WHEN enough THEN 0.0 ELSE round_even(units2 * cost, 0) + 0.0 END AS net_buy_usd
  FROM g11),
retail AS (
  SELECT code_key, arg_min(price, ingest_row) AS retail FROM inv WHERE price > 0 GROUP BY code_key),
terms AS (
  SELECT code_key,
         CASE WHEN case_cost / units_case > 0 THEN round_even((1.0 - net_unit / (case_cost / units_case)) * 100, 1) + 0.0 END AS discount_pct,
         'case of ' || CAST(units_case AS VARCHAR) AS deal
  FROM deals),
g13 AS (
  SELECT g12.*, r.retail, tm.discount_pct,
         CASE WHEN r.retail > 0 THEN round_even((r.retail - cost) / r.retail * 100, 0) + 0.0 END AS gm_pct,
         coalesce(tm.deal, '') AS deal0,
         'ON AD - ' || CASE WHEN lower(ad_kind) LIKE 'sun%' THEN 'Sunday' ELSE 'weekly' END || ' special (buy to '
           || regexp_replace(CAST(coalesce(ad_target, 4.5) AS VARCHAR), '\\.0$', '') || 'w)' AS tag
  FROM g12 LEFT JOIN retail r ON r.code_key = g12.code_key LEFT JOIN terms tm ON tm.code_key = g12.code_key),
g14 AS (
  SELECT g13.*,
         CASE WHEN on_ad THEN CASE WHEN deal0 <> '' THEN tag || '; ' || deal0 ELSE tag END ELSE deal0 END AS deal_terms,
         wk_vel * greatest(coalesce(retail, cost) - cost, 0) AS profit_protected
  FROM g13),
buy AS (
  SELECT g14.*,
         (code_key IN (SELECT code_key FROM remove_list)) OR lower(coalesce(supplier, '')) LIKE '%discontinued%' AS removed,
         code_key IN (SELECT code_key FROM new_list) AS is_new
  FROM g14 WHERE buy_units > 0),
buy2 AS (
  SELECT buy.*,
         CASE WHEN mtxt IS NULL THEN ''
              WHEN in_month THEN 'In buy-month (' || mtxt || ')' ||
                   CASE WHEN bm_wks >= 4 THEN ' - stock up ~' || CAST(CAST(round_even(bm_wks, 0) AS BIGINT) AS VARCHAR) || 'wks to next deal' ELSE '' END
              WHEN wos IS NOT NULL AND wos < 2 THEN 'Off-month, buy anyway - urgent (deal: ' || mtxt || ')'
              ELSE 'Wait for buy-month (' || mtxt || ')' END AS bmn
  FROM buy),
buy3 AS (
  SELECT buy2.*,
         CASE WHEN removed THEN 'removed' WHEN bmn LIKE 'Wait for%' THEN 'wait' ELSE 'order' END AS section
  FROM buy2),
lines AS (
  SELECT dept, item, trim(regexp_replace(code, '\\.0$', '')) AS product_code, category, supplier, chain_oh, wos,
         trend, ly_wk, gross_need, transfer, buy_units, buy_cases, round_even(cost, 2) + 0.0 AS unit_cost,
         net_buy_usd, gm_pct, discount_pct, deal_terms,
         CASE WHEN removed THEN '' ELSE bmn END AS buy_month,
         CASE WHEN section <> 'order' THEN '' ELSE coalesce(concat_ws('; ',
           CASE WHEN NOT coalesce(cost > 0, false) THEN 'No cost data - verify price' END,
           CASE WHEN gm_pct IS NULL OR gm_pct < 0 THEN 'Margin looks off - check retail/cost'
                WHEN gm_pct > 95 THEN 'Margin over 95% - check retail' END,
           CASE WHEN net_buy_usd >= 4000 THEN 'Large buy ($' || format('{{:,}}', CAST(net_buy_usd AS BIGINT)) || ') - confirm' END,
           CASE WHEN wos IS NOT NULL AND wos > 8 AND NOT bmn LIKE 'In buy-month%'
                THEN 'Overstocked (' || CAST(CAST(round_even(wos, 0) AS BIGINT) AS VARCHAR) || ' wks on hand) - confirm before buying more' END,
           CASE WHEN bmn LIKE 'In buy-month%' AND bmn LIKE '%stock up%'
                THEN 'Buy-month stock-up ($' || format('{{:,}}', CAST(net_buy_usd AS BIGINT)) || ' to next deal) - confirm' END,
           CASE WHEN is_new THEN 'New item - set quantity by hand' END,
           CASE WHEN bmn LIKE 'Off-month%' THEN 'Off buy-month - confirm timing' END,
           CASE WHEN ly_wk IS NOT NULL AND ly_wk >= 2 AND ly_wk >= 1.5 * wk_vel
                THEN 'Seasonal - last year ~' || CAST(CAST(round_even(ly_wk, 0) AS BIGINT) AS VARCHAR) || '/wk vs '
                     || CAST(CAST(round_even(wk_vel, 0) AS BIGINT) AS VARCHAR) || ' now, buy ahead?' END), '') END AS review,
         section, wos AS _wos, profit_protected AS _pp, cost AS _cost, pack AS _pack
  FROM buy3)"""

_HEAD = with_views(_VIEWS, INV, NEED, TRANSFER, ORDER)
_COLS = """dept, item, product_code, category, supplier, chain_oh, wos, trend, ly_wk, gross_need, transfer,
 buy_units, buy_cases, unit_cost, net_buy_usd, gm_pct, discount_pct, deal_terms, buy_month, review"""

SQL = {}
SQL["weekly_order"] = _HEAD + f"\nSELECT {_COLS} FROM lines WHERE section = 'order'"
SQL["needs_review"] = _HEAD + f"\nSELECT {_COLS} FROM lines WHERE section = 'order' AND length(review) > 0"
SQL["being_removed"] = _HEAD + f"\nSELECT {_COLS} FROM lines WHERE section = 'removed'"
SQL["buy_month_wait"] = _HEAD + f"\nSELECT {_COLS} FROM lines WHERE section = 'wait'"
SQL["budget_prefix"] = _HEAD + """,
ranked AS (
  SELECT dept, item, wos, net_buy_usd,
         sum(net_buy_usd) OVER (PARTITION BY dept ORDER BY _wos ASC NULLS LAST, _pp DESC NULLS LAST, item
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_buy
  FROM lines WHERE section = 'order')
SELECT dept, item, wos, net_buy_usd, cum_buy, CASE WHEN cum_buy <= 50000 THEN 'order' ELSE 'deferred' END AS section
FROM ranked"""
SQL["weekly_order_overrides"] = with_views([*_VIEWS, "order_decisions"], INV, NEED, TRANSFER, ORDER) + """,
ov AS (
  SELECT l.*, d.action, d.note, coalesce(d.action = 'qty', false) AND d.qty IS NOT NULL AS is_qty, TRY_CAST(d.qty AS DOUBLE) AS q
  FROM lines l LEFT JOIN order_decisions d
    ON lower(trim(l.dept)) = lower(trim(d.dept)) AND lower(trim(l.item)) = lower(trim(d.item))
  WHERE l.section = 'order' AND coalesce(d.action, '') <> 'skip'),
ov2 AS (SELECT *, CASE WHEN is_qty AND q IS NOT NULL THEN greatest(CAST(trunc(q) AS BIGINT), 0) ELSE buy_units END AS units2 FROM ov)
SELECT dept, item, product_code, category, supplier, chain_oh, wos, trend, ly_wk, gross_need, transfer, units2 AS buy_units,
       CASE WHEN is_qty THEN round_even(units2 / _pack, 1) + 0.0 ELSE buy_cases END AS buy_cases, unit_cost,
       CASE WHEN is_qty THEN round_even(units2 * _cost, 0) + 0.0 ELSE net_buy_usd END AS net_buy_usd,
       gm_pct, discount_pct, deal_terms, buy_month,
       CASE WHEN action IN ('approve', 'qty') THEN '' WHEN action = 'fix' AND coalesce(note, '') <> '' THEN 'FIX REQUESTED: ' || note
            ELSE review END AS review
FROM ov2"""
for _name, _by in {"margin": "gm_pct DESC NULLS LAST, _pp DESC NULLS LAST", "deals": "(length(deal_terms) > 0) DESC, _pp DESC NULLS LAST",
                   "balanced": "_pp DESC NULLS LAST"}.items():
    SQL[f"rank_{_name}"] = _HEAD + f""",
ranked AS (
  SELECT dept, item, net_buy_usd, sum(net_buy_usd) OVER (PARTITION BY dept ORDER BY {_by}, item
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_buy FROM lines WHERE section = 'order')
SELECT dept, item, net_buy_usd, cum_buy, CASE WHEN cum_buy <= 50000 THEN 'order' ELSE 'deferred' END AS section FROM ranked"""
SQL["dept_summary"] = _HEAD + """,
money AS (
  SELECT r.dept, sum(round_even(coalesce(t.gross_need, 0) * r.cost, 0)) AS gross_usd,
         sum(round_even(coalesce(t.transfer, 0) * r.cost, 0)) AS transfer_usd
  FROM roll r LEFT JOIN titems t ON t.dept = r.dept AND t.item = r.item GROUP BY r.dept),
net AS (SELECT dept, count(*) AS items, sum(net_buy_usd) AS net_buy_usd FROM lines WHERE section = 'order' GROUP BY dept),
per AS (SELECT m.dept, coalesce(n.items, 0) AS items, m.gross_usd, m.transfer_usd, coalesce(n.net_buy_usd, 0.0) AS net_buy_usd
        FROM money m LEFT JOIN net n ON n.dept = m.dept)
SELECT dept, CAST(sum(items) AS BIGINT) AS items, sum(gross_usd) AS gross_usd, sum(transfer_usd) AS transfer_usd,
       sum(net_buy_usd) AS net_buy_usd
FROM per GROUP BY ROLLUP (dept)"""
