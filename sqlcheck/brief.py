"""Oracle SQL: daily brief (restock, pricing, deals), snapshot, chain by code."""

from .common import INV, dept_case, norm_code, with_views
from .history import CAT, H, ITEM

_DEPT = "dept IS NOT NULL"

FACTORS = """ifac AS (SELECT code, least(greatest(jul / jun, 0.7), 1.8) AS f FROM iwide
         WHERE jun > 0 AND jul IS NOT NULL AND code IN (SELECT code FROM ibase)),
cfac AS (SELECT category, least(greatest(jul / jun, 0.8), 1.5) AS f FROM cseason WHERE jun > 0 AND jul IS NOT NULL)"""

TERMS = """terms AS (
  SELECT code_key,
         CASE WHEN case_cost / units_case > 0 THEN round_even((1.0 - net_unit / (case_cost / units_case)) * 100, 1) + 0.0 END AS discount_pct,
         CASE WHEN retail > 0 THEN round_even((retail - net_unit) / retail * 100, 1) + 0.0 END AS buyer_gm_pct,
         'case of ' || CAST(units_case AS VARCHAR) AS deal
  FROM deals)"""

RESTOCK = f"""b0 AS (
  SELECT *, 0.6 * (u30 * 7 / 30) + 0.4 * (u90 * 7 / 90) AS vel,
         CASE WHEN u90 * 7 / 90 > 0 THEN (u30 * 7 / 30) / (u90 * 7 / 90) ELSE 1.0 END AS trend_r
  FROM inv WHERE {_DEPT}),
b1 AS (
  SELECT b0.*, coalesce(i.f, c.f, 1.0) AS season_f, CASE WHEN i.f IS NOT NULL THEN 'item' ELSE 'category' END AS season_src
  FROM b0 LEFT JOIN ifac i ON i.code = {norm_code('b0.code')} LEFT JOIN cfac c ON c.category = trim(b0.category)),
b2 AS (
  SELECT *, CAST(ceil(vel * 3 * season_f) AS DOUBLE) AS target, greatest(on_hand, 0) AS ohp FROM b1),
rs AS (
  SELECT *, greatest(target - ohp, 0) AS need, greatest(ohp - target, 0) AS surp FROM b2),
ritem AS (SELECT item, median(price_raw) AS price, arg_min(code, ingest_row) AS item_code FROM rs GROUP BY item),
rrecv AS (SELECT item, store, ingest_row, need, row_number() OVER (PARTITION BY item ORDER BY vel DESC, store, ingest_row) AS k
          FROM rs WHERE need > 0),
rwalk(item, k, donor, avail, take, before) AS (
  SELECT item, CAST(0 AS BIGINT), store, surp, CAST(0 AS DOUBLE), surp FROM rs WHERE surp > 0
  UNION ALL
  SELECT item, k, donor, avail - take, take, avail FROM (
    SELECT x.*, CASE WHEN avail > 0 THEN greatest(CAST(0 AS DOUBLE), least(need - prev, avail)) ELSE CAST(0 AS DOUBLE) END AS take FROM (
      SELECT w.item, w.k + 1 AS k, w.donor, w.avail, v.need,
             coalesce(sum(w.avail) OVER (PARTITION BY w.item ORDER BY w.avail DESC, w.donor
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
      FROM rwalk w JOIN rrecv v ON v.item = w.item AND v.k = w.k + 1) x) y),
rgot AS (
  SELECT v.item, v.ingest_row, coalesce(sum(w.take), 0) AS got,
         string_agg(CAST(CAST(trunc(w.take) AS BIGINT) AS VARCHAR) || ' from ' || w.donor, ', '
                    ORDER BY w.before DESC, w.donor) FILTER (WHERE w.take > 0) AS xfer
  FROM rrecv v LEFT JOIN rwalk w ON w.item = v.item AND w.k = v.k GROUP BY v.item, v.ingest_row)"""

SQL = {}
SQL["restock_brief"] = with_views(["inventory", "history", "deals"], INV, H, CAT, ITEM, FACTORS, TERMS, RESTOCK) + f""",
rows AS (
  SELECT r.*, g.got, g.xfer, ri.price, ri.item_code,
         CAST(trunc(greatest(r.need - g.got, 0)) AS BIGINT) AS buy
  FROM rs r JOIN rgot g ON g.item = r.item AND g.ingest_row = r.ingest_row JOIN ritem ri ON ri.item = r.item WHERE r.need > 0)
SELECT rows.dept, rows.item, rows.store, CASE WHEN ohp = 0 AND vel > 0 THEN 'STOCKOUT' ELSE '' END AS stockout,
       CAST(trunc(on_hand) AS BIGINT) AS on_hand, round_even(vel, 1) + 0.0 AS wk_velocity,
       CASE WHEN trend_r >= 1.2 THEN 'rising' WHEN trend_r <= 0.8 THEN 'falling' ELSE 'steady' END AS trend,
       round_even(season_f, 2) + 0.0 AS season_x, season_src AS season_basis,
       CAST(trunc(need) AS BIGINT) AS need, CAST(trunc(got) AS BIGINT) AS transfer_qty, buy AS buy_qty,
       CASE WHEN price IS NOT NULL THEN round_even(vel * price, 2) + 0.0 ELSE 0.0 END AS wk_usd_at_risk,
       t.discount_pct, t.buyer_gm_pct, coalesce(t.deal, '') AS deal_terms,
       CASE WHEN buy > 0 THEN CASE WHEN xfer IS NOT NULL THEN 'Transfer ' || xfer || '; BUY ' || CAST(buy AS VARCHAR)
                                   ELSE 'BUY ' || CAST(buy AS VARCHAR) END
            ELSE coalesce('Transfer ' || xfer, '') END AS action
FROM rows LEFT JOIN terms t ON t.code_key = {norm_code('rows.item_code')}"""

SQL["pricing_flags"] = with_views(["inventory", "market_price"]) + f""",
ours AS (SELECT {dept_case()} AS dept, {norm_code('code')} AS upc, item, median(price) AS our FROM inventory WHERE {dept_case()} IS NOT NULL
         GROUP BY {dept_case()}, {norm_code('code')}, item HAVING median(price) > 0),
mkt AS (SELECT code_key AS upc, avg(market) AS mkt FROM market_price GROUP BY code_key),
j AS (SELECT o.*, m.mkt, c.comp_a, c.comp_b FROM ours o LEFT JOIN mkt m ON m.upc = o.upc
      LEFT JOIN (SELECT * FROM market_price QUALIFY row_number() OVER (PARTITION BY code_key ORDER BY list_row DESC) = 1) c
        ON c.code_key = o.upc),
j2 AS (SELECT *, CASE WHEN comp_a IS NULL THEN comp_b WHEN comp_b IS NULL THEN comp_a ELSE least(comp_a, comp_b) END AS best FROM j),
j3 AS (SELECT *, coalesce(best, mkt) AS bench,
              CASE WHEN best IS NOT NULL THEN concat_ws('/', CASE WHEN comp_a = best THEN 'comp_a' END,
                                                        CASE WHEN comp_b = best THEN 'comp_b' END)
                   WHEN mkt IS NOT NULL THEN 'Market' END AS vs FROM j2),
j4 AS (SELECT *, (our - bench) / bench * 100 AS gap FROM j3 WHERE bench IS NOT NULL AND bench > 0)
SELECT dept, item, round_even(our, 2) + 0.0 AS our_price, round_even(comp_a, 2) + 0.0 AS comp_a, round_even(comp_b, 2) + 0.0 AS comp_b,
       round_even(mkt, 2) + 0.0 AS market_mean, round_even(bench, 2) + 0.0 AS market_price, vs,
       round_even(gap, 1) + 0.0 AS gap_pct,
       CASE WHEN gap >= 10 THEN 'ABOVE market (review)' ELSE 'BELOW market (raise)' END AS flag
FROM j4 WHERE gap >= 10 OR gap <= -15"""

SQL["deal_evaluation"] = with_views(["inventory", "history", "deals"], INV, H, CAT, ITEM, FACTORS) + f""",
byupc AS (SELECT {norm_code('code')} AS upc, sum(on_hand) AS oh, 0.6 * sum(u30) * 7 / 30 + 0.4 * sum(u90) * 7 / 90 AS wk_vel
          FROM inv WHERE {_DEPT} GROUP BY {norm_code('code')}),
d0 AS (SELECT *, {norm_code('code_key')} AS upc, CASE WHEN units_case > 0 THEN CAST(units_case AS BIGINT) ELSE 1 END AS uc
       FROM deals_rows WHERE case_cost IS NOT NULL AND net_unit IS NOT NULL AND case_cost > 0 AND net_unit > 0),
d1 AS (SELECT *, case_cost / uc AS reg_cost, case_cost / uc - net_unit AS savings FROM d0),
d2 AS (SELECT *, savings / reg_cost * 100 AS disc,
              CASE WHEN min_cases > 0 THEN CAST(trunc(min_cases * uc) AS BIGINT) ELSE 0 END AS min_units
       FROM d1 WHERE savings > 0.01),
d3 AS (SELECT d2.*, coalesce(b.oh, 0.0) AS oh, coalesce(b.wk_vel, 0.0) AS wk_vel,
              coalesce(CASE WHEN i.f <> 0 THEN i.f END, CASE WHEN c.f <> 0 THEN c.f END, 1.0) AS season_f
       FROM d2 LEFT JOIN byupc b ON b.upc = d2.upc LEFT JOIN ifac i ON i.code = d2.upc
       LEFT JOIN cfac c ON c.category = d2.category WHERE disc <= 80),
d4 AS (SELECT *, wk_vel * season_f AS eff_vel,
              CASE WHEN wk_vel > 0 THEN round_even(oh / wk_vel, 1) + 0.0 END AS wos FROM d3),
d5 AS (SELECT *, greatest(CAST(ceil(greatest(eff_vel * 8 - oh, 0) / uc) * uc AS BIGINT), min_units) AS suggested FROM d4),
d6 AS (SELECT *, CASE WHEN eff_vel > 0 THEN round_even(suggested / eff_vel, 1) + 0.0 END AS wks_to_sell,
              CASE WHEN retail IS NOT NULL AND retail <> 0 THEN (retail - net_unit) / retail * 100 END AS margin_at,
              greatest(min_units, CAST(ceil(eff_vel * 8 / uc) * uc AS BIGINT)) AS good FROM d5)
SELECT code_key, item, category, 'case of ' || CAST(units_case AS VARCHAR) AS deal,
       round_even(reg_cost, 2) + 0.0 AS reg_cost, round_even(net_unit, 2) + 0.0 AS deal_cost,
       round_even(savings, 2) + 0.0 AS savings_unit, round_even(disc, 0) + 0.0 AS disc_pct,
       round_even(eff_vel, 1) + 0.0 AS wk_velocity, wos, CAST(trunc(oh) AS BIGINT) AS on_hand,
       min_units AS min_buy, suggested AS suggested_buy, wks_to_sell,
       round_even(margin_at, 0) + 0.0 AS margin_at_deal, round_even(savings * eff_vel, 0) + 0.0 AS weekly_saved,
       CASE WHEN eff_vel <= 0 THEN 'SKIP - not selling (any quantity would sit)'
            WHEN suggested <= 0 THEN 'WELL-STOCKED (' || coalesce(CAST(wos AS VARCHAR), 'None') || ' wks on hand) - skip the deal for now'
            WHEN disc < 3 THEN 'MARGINAL - only ' || CAST(CAST(round_even(disc, 0) AS BIGINT) AS VARCHAR) || '% off cost'
            WHEN coalesce(wks_to_sell, 0) > 16 THEN 'CAUTION - ' || CAST(suggested AS VARCHAR) || 'u = ~'
                 || CAST(CAST(round_even(wks_to_sell, 0) AS BIGINT) AS VARCHAR) || ' wks (overstock); consider ~' || CAST(good AS VARCHAR) || 'u'
            ELSE 'BUY ~' || CAST(suggested AS VARCHAR) || 'u (' || CAST(suggested // uc AS VARCHAR) || 'cs) - sells in ~'
                 || CAST(CAST(round_even(wks_to_sell, 0) AS BIGINT) AS VARCHAR) || ' wks'
                 || CASE WHEN season_f >= 1.1 THEN ' (rising into season)' WHEN season_f <= 0.9 THEN ' (cooling)' ELSE '' END END AS verdict
FROM d6"""

SQL["inventory_snapshot"] = with_views(["inventory", "deals"], INV) + f""",
g AS (SELECT dept, item, sum(on_hand) AS oh, sum(u30) AS u30, sum(u90) AS u90,
             arg_min(code, ingest_row) AS code, arg_min(category, ingest_row) AS category,
             arg_min(supplier, ingest_row) AS supplier, median(cost) AS avgc, median(price) AS ret0, median(club_price) AS club0,
             string_agg(CASE WHEN on_hand > 0 THEN store || ':' || CAST(CAST(trunc(on_hand) AS BIGINT) AS VARCHAR) END, ';'
                        ORDER BY ingest_row) AS by_store
      FROM sinv GROUP BY dept, item),
g2 AS (SELECT g.*, 0.6 * u30 * 7 / 30 + 0.4 * u90 * 7 / 90 AS vel,
              coalesce(round_even(d.net_unit, 2), CASE WHEN avgc > 0 THEN avgc END) AS ucost,
              CASE WHEN ret0 > 0 THEN ret0 END AS ret, 'case of ' || CAST(d.units_case AS VARCHAR) AS ref_deal
       FROM g LEFT JOIN deals d ON d.code_key = {norm_code('g.code')})
SELECT dept, item, category, supplier, CAST(trunc(oh) AS BIGINT) AS chain_oh, round_even(vel, 1) + 0.0 AS wk_velocity,
       CASE WHEN vel > 0 THEN round_even(oh / vel, 1) + 0.0 END AS wos, round_even(ucost, 2) + 0.0 AS cost,
       round_even(ret, 2) + 0.0 AS retail, CASE WHEN club0 > 0 THEN round_even(club0, 2) + 0.0 END AS club,
       CASE WHEN ret IS NOT NULL AND ucost IS NOT NULL THEN CAST(round_even((ret - ucost) / ret * 100, 0) AS BIGINT) END AS margin_pct,
       coalesce(ref_deal, '') AS deal, CAST(trunc(u30) AS BIGINT) AS units_30d, CAST(trunc(u90) AS BIGINT) AS units_90d,
       coalesce(by_store, '') AS by_store_oh
FROM g2"""

SQL["chain_by_code"] = with_views(["inventory"], INV) + f"""
SELECT code_key, sum(on_hand) AS oh, sum(u30) AS u30, sum(u90) AS u90, round_even(median(price_raw), 4) + 0.0 AS price,
       arg_min(category, ingest_row) FILTER (WHERE category IS NOT NULL) AS category,
       round_even(0.6 * sum(u30) * 7 / 30 + 0.4 * sum(u90) * 7 / 90, 4) + 0.0 AS vel
FROM inv WHERE {_DEPT} GROUP BY code_key"""
