"""Oracle SQL: order-side queries."""

from .common import INV, NEED, TRANSFER, with_views

_BASE = ["inventory", "par_list"]

SQL = {}

SQL["reorder_need"] = with_views(_BASE, INV, NEED) + """
SELECT dept, store, item, code_key, on_hand, round_even(vel, 4) + 0.0 AS vel,
       round_even(need, 4) + 0.0 AS need, par_cases, has_par
FROM needs"""

SQL["transfer_plan"] = with_views(_BASE, INV, NEED, TRANSFER) + """
SELECT * FROM moves"""

SQL["transfer_items"] = with_views(_BASE, INV, NEED, TRANSFER) + """
SELECT * FROM titems"""

SQL["transfer_plan_ranked"] = with_views(_BASE, INV, NEED, TRANSFER) + """,
icost AS (SELECT dept, item, median(cost) AS cost FROM needs GROUP BY dept, item)
SELECT m.*, round_even(m.transfer_in * c.cost, 0) + 0.0 AS value,
       CASE m.priority WHEN 'STOCKOUT' THEN 0 WHEN 'Low <2wk' THEN 1 WHEN 'Top-up' THEN 2 ELSE 3 END AS priority_rank
FROM moves m LEFT JOIN icost c ON c.dept = m.dept AND c.item = m.item"""

SQL["store_orders"] = with_views(_BASE + ["remove_list"], INV, NEED) + """,
so AS (SELECT *, CASE WHEN case_pack = 0 THEN 1.0 ELSE case_pack END AS pack FROM needs
       WHERE need > 0 AND code_key NOT IN (SELECT code_key FROM remove_list)),
so2 AS (SELECT *, CAST(greatest(ceil(need / pack), 1) AS BIGINT) AS order_cases FROM so)
SELECT dept, trim(store) AS store, supplier, item, trim(regexp_replace(code, '\\.0$', '')) AS product_code,
       CAST(trunc(on_hand) AS BIGINT) AS store_oh,
       CASE WHEN vel > 0 THEN round_even(on_hand / vel, 1) + 0.0 END AS wos,
       order_cases, CAST(round_even(order_cases * pack, 0) AS BIGINT) AS order_units,
       round_even(cost, 2) + 0.0 AS unit_cost,
       round_even(CAST(round_even(order_cases * pack, 0) AS BIGINT) * cost, 0) + 0.0 AS order_usd
FROM so2"""
