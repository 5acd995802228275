"""Oracle SQL: live sales rollup, purchase-order reports, vendor/store rollups."""

from . import brief, order, weekly
from .common import with_views

SQL = {}

SQL["live_rollup"] = with_views(["sales_lines"]) + """,
l AS (SELECT *, CAST(timezone('America/Chicago', timezone('UTC', ts)) AS DATE) AS day,
             coalesce(CASE trim(department) WHEN 'view' THEN 'THC' WHEN 'click' THEN 'Beer' WHEN 'purchase' THEN 'Wine'
                      WHEN 'signup' THEN 'Spirits' END, 'Other') AS dept
      FROM sales_lines WHERE trim(coalesce(code, '')) <> ''),
base AS (SELECT day, dept, trim(store) AS store, trim(code) AS code, sum(quantity) AS u, sum(total) AS s,
                arg_min(trim(description), (ts, event_id)) AS d, min((ts, event_id)) AS f
         FROM l GROUP BY day, dept, trim(store), trim(code)),
st AS (SELECT day, dept, store, CAST(round_even(sum(u), 0) AS BIGINT) AS units, sum(s) AS sales FROM base GROUP BY day, dept, store),
dp AS (SELECT day, dept, sum(units) AS units, sum(sales) AS sales FROM st GROUP BY day, dept),
ch AS (SELECT day, CAST(round_even(sum(u), 0) AS BIGINT) AS units, sum(s) AS sales FROM base GROUP BY day),
pr AS (SELECT day, dept, code, CAST(round_even(sum(u), 0) AS BIGINT) AS units, sum(s) AS sales, arg_min(d, f) AS item
       FROM base GROUP BY day, dept, code),
top AS (SELECT *, row_number() OVER (PARTITION BY day, dept ORDER BY sales DESC, code) AS rank FROM pr)
SELECT 'chain' AS level, day, NULL AS dept, NULL AS store, NULL AS code, NULL AS item, units, sales, NULL AS rank FROM ch
UNION ALL SELECT 'dept', day, dept, NULL, NULL, NULL, units, sales, NULL FROM dp
UNION ALL SELECT 'dept_store', day, dept, store, NULL, NULL, units, sales,
                 row_number() OVER (PARTITION BY day, dept ORDER BY sales DESC, store) FROM st
UNION ALL SELECT 'dept_product', day, dept, NULL, code, item, units, sales, rank FROM top WHERE rank <= 25"""

_PO = """base AS (SELECT *, cases_ordered - cases_received AS case_discrepancy FROM po_lines WHERE trim(coalesce(vendor, '')) <> ''),
u AS (SELECT 'Receiving' AS source, * FROM base WHERE status = 'Receiving'
      UNION ALL
      SELECT 'Discrepancy', * FROM base WHERE status IN ('Inventory Received', 'Receiving') AND case_discrepancy <> 0
        AND created > DATE '2001-06-30' - 21)"""

SQL["open_po_report"] = with_views(["po_lines"], _PO) + """
SELECT source, code, vendor, location, ref, status, cases_ordered, cases_received, case_discrepancy, department, category, created
FROM u WHERE trim(coalesce(code, '')) <> ''
  AND lower(trim(coalesce(department, ''))) NOT IN ('standard', 'large', 'small')
  AND NOT (lower(trim(coalesce(department, ''))) IN ('promo') AND lower(trim(coalesce(category, ''))) IN ('brand#1', 'brand#2'))"""

SQL["open_po_wine"] = SQL["open_po_report"].replace("FROM po_lines", "FROM (SELECT * FROM po_lines WHERE contains(lower(team), 'wine')) po")

SQL["sink_vendor_split"] = with_views(["po_lines"]) + """,
v AS (SELECT coalesce(nullif(trim(vendor), ''), 'Unknown') AS vendor FROM po_lines
      WHERE status = 'Receiving' AND created > DATE '2001-06-30' - 4 AND trim(coalesce(code, '')) <> '')
SELECT vendor, trim(regexp_replace(vendor, '[^A-Za-z0-9_ .-]', '_', 'g')) || '.csv' AS file, count(*) AS lines
FROM v GROUP BY vendor"""

SQL["freshness"] = with_views(["history"]) + """
SELECT max(day) AS data_date, DATE '2001-06-30' AS as_of, datediff('day', max(day), DATE '2001-06-30') AS stale_days,
       CASE WHEN datediff('day', max(day), DATE '2001-06-30') >= 1 THEN 'stale' ELSE 'ok' END AS health
FROM history"""

SQL["vendor_rollup"] = f"""SELECT dept, supplier, count(*) AS items, sum(buy_units) AS units, sum(coalesce(net_buy_usd, 0)) AS dollars
FROM ({weekly.SQL['weekly_order']}) o GROUP BY dept, supplier"""

SQL["store_vendor_rollup"] = f"""SELECT dept, store, supplier, count(*) AS items, sum(order_cases) AS cases, sum(coalesce(order_usd, 0)) AS dollars
FROM ({order.SQL['store_orders']}) so GROUP BY dept, store, supplier"""

SQL["store_receiving_rollup"] = f"""SELECT dept, to_store, count(*) AS items, sum(coalesce(value, 0)) AS transfer_in_value,
       count(*) FILTER (WHERE priority = 'STOCKOUT') AS stockouts
FROM ({order.SQL['transfer_plan_ranked']}) m GROUP BY dept, to_store"""

SQL["headline_kpis"] = weekly._HEAD + """,
o AS (SELECT dept, count(*) FILTER (WHERE section = 'order') AS items,
             sum(buy_units) FILTER (WHERE section = 'order') AS units,
             sum(net_buy_usd) FILTER (WHERE section = 'order') AS net_buy,
             count(*) FILTER (WHERE section = 'wait') AS wait_items,
             sum(net_buy_usd) FILTER (WHERE section = 'wait') AS wait_buy,
             count(*) FILTER (WHERE section = 'order' AND length(review) > 0) AS review_items
      FROM lines GROUP BY dept),
m AS (SELECT dept, count(*) AS transfers, sum(transfer_in) AS rebalance_units,
             count(*) FILTER (WHERE priority = 'STOCKOUT') AS stockouts, count(*) FILTER (WHERE priority = 'Low <2wk') AS low
      FROM moves GROUP BY dept)
SELECT coalesce(o.dept, m.dept) AS dept, items, units, net_buy, wait_items, wait_buy, review_items, transfers,
       rebalance_units, stockouts, low, transfers - stockouts - low AS routine
FROM o FULL OUTER JOIN m ON m.dept = o.dept"""

SQL["vendor_order"] = f"""SELECT o.dept, o.supplier, o.item, o.buy_units, o.buy_cases, o.net_buy_usd,
       sum(o.buy_units) OVER (PARTITION BY o.dept, o.supplier) AS vendor_units,
       sum(o.net_buy_usd) OVER (PARTITION BY o.dept, o.supplier) AS vendor_total,
       coalesce(s.by_store_oh, '') AS by_store,
       (coalesce(s.by_store_oh, '') = '' AND coalesce(s.chain_oh, 0) <= 0) AS oos
FROM ({weekly.SQL['weekly_order']}) o LEFT JOIN ({brief.SQL['inventory_snapshot']}) s
  ON s.dept = o.dept AND lower(trim(s.item)) = lower(trim(o.item))"""

SQL["store_order"] = f"""SELECT dept, store, supplier, item, product_code, store_oh, wos, order_cases, order_units, order_usd,
       sum(order_units) OVER w AS total_units, sum(order_cases) OVER w AS total_cases, sum(order_usd) OVER w AS total_usd
FROM ({order.SQL['store_orders']}) so WINDOW w AS (PARTITION BY dept, store, supplier)"""
