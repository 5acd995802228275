"""Oracle SQL: history insights."""

from .common import with_views

_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_M = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

H = """h AS (SELECT day, code, category, item, coalesce(CAST(units AS DOUBLE), 0) AS units,
              year(day) AS y, month(day) AS m, CAST(date_trunc('month', day) AS DATE) AS ym FROM history),
fm AS (SELECT ym, count(DISTINCT day) AS n_days FROM h GROUP BY ym HAVING count(DISTINCT day) >= 25),
hf AS (SELECT * FROM h WHERE ym IN (SELECT ym FROM fm))"""


def _wide(key: str, src: str) -> str:
    cols = ", ".join(f"max(CASE WHEN m = {i + 1} THEN round_even(idx, 2) + 0.0 END) AS {n}" for i, n in enumerate(_M))
    return f"SELECT {key}, {cols} FROM {src} GROUP BY {key}"


CAT = """cmt AS (SELECT category, ym, month(ym) AS m, sum(units) AS units FROM hf GROUP BY category, ym),
cbase AS (SELECT category, sum(units) / count(units) AS base FROM cmt GROUP BY category HAVING sum(units) / count(units) > 0),
cidx AS (SELECT c.category, c.m, (sum(c.units) / count(c.units)) / max(b.base) AS idx, max(b.base) AS base
         FROM cmt c JOIN cbase b ON b.category = c.category GROUP BY c.category, c.m),
cwide AS (""" + _wide("category", "cidx") + """),
cseason AS (
  SELECT w.category, CAST(round_even(max(i.base), 0) AS BIGINT) AS avg_units_mo,
         """ + ", ".join(f"max(w.{n}) AS {n}" for n in _M) + """,
         coalesce(string_agg(CASE WHEN i.idx >= 1.15 THEN """ + _MONTHS + """[i.m] END, ', ' ORDER BY i.m), '') AS peak_months
  FROM cwide w JOIN cidx i ON i.category = w.category GROUP BY w.category)"""

ITEM = """info AS (SELECT code, sum(units) AS tot, arg_min(item, day) AS item, arg_min(category, day) AS category
         FROM hf GROUP BY code HAVING sum(units) >= 200),
imt AS (SELECT code, ym, month(ym) AS m, sum(units) AS units FROM hf WHERE code IN (SELECT code FROM info) GROUP BY code, ym),
ibase AS (SELECT code, sum(units) / count(units) AS base FROM imt GROUP BY code HAVING sum(units) / count(units) > 0 AND count(DISTINCT m) >= 6),
iidx AS (SELECT c.code, c.m, (sum(c.units) / count(c.units)) / max(b.base) AS idx, max(b.base) AS base
         FROM imt c JOIN ibase b ON b.code = c.code GROUP BY c.code, c.m),
iwide AS (""" + _wide("code", "iidx") + """),
ipeak AS (SELECT code, max(idx) AS peak_v, min(m) FILTER (WHERE idx = mx) AS peak_m
          FROM (SELECT *, max(idx) OVER (PARTITION BY code) AS mx FROM iidx) GROUP BY code)"""

SQL = {}
SQL["src_history"] = with_views(["history"], H) + "\nSELECT day, code, category, item, units, y, m, ym FROM h"
SQL["full_months"] = with_views(["history"], H) + "\nSELECT * FROM fm"
SQL["category_seasonality"] = with_views(["history"], H, CAT) + "\nSELECT * FROM cseason"
SQL["item_seasonality"] = with_views(["history"], H, ITEM) + """
SELECT p.code, i.item, i.category, CAST(i.tot AS BIGINT) AS annual_units, """ + _MONTHS + """[p.peak_m] AS peak_month,
       round_even(p.peak_v, 2) + 0.0 AS peak_index, """ + _MONTHS + """[((p.peak_m - 2 + 12) % 12) + 1] AS buy_ahead_month
FROM ipeak p JOIN info i ON i.code = p.code WHERE p.peak_v >= 1.15"""
SQL["buy_ahead"] = with_views(["history"], H, ITEM) + """
SELECT * FROM (
SELECT p.code, i.item, i.category, CAST(i.tot AS BIGINT) AS annual_units, """ + _MONTHS + """[p.peak_m] AS peak_month,
       round_even(p.peak_v, 2) + 0.0 AS peak_index, """ + _MONTHS + """[((p.peak_m - 2 + 12) % 12) + 1] AS buy_ahead_month
FROM ipeak p JOIN info i ON i.code = p.code WHERE p.peak_v >= 1.15) WHERE buy_ahead_month = 'Jun'"""
SQL["item_month_index"] = with_views(["history"], H, ITEM) + """
SELECT b.code, i.item, i.category, CAST(round_even(b.base, 0) AS BIGINT) AS avg_units_mo, """ + \
    ", ".join(f"w.{n}" for n in _M) + """
FROM ibase b JOIN info i ON i.code = b.code JOIN iwide w ON w.code = b.code"""
SQL["event_lift"] = with_views(["history"], H) + """,
daily AS (SELECT day, sum(units) AS units FROM h GROUP BY day),
yrs AS (SELECT DISTINCT year(day) AS y FROM daily),
ev AS (
  SELECT '4/20 ' || y AS event, make_date(y, 4, 20) AS date FROM yrs
  UNION ALL SELECT 'July 4 ' || y, make_date(y, 7, 4) FROM yrs
  UNION ALL SELECT 'NYE ' || y, make_date(y, 12, 31) FROM yrs
  UNION ALL SELECT 'Green Wed ' || y,
    (SELECT min(d) + 20 FROM (SELECT make_date(y, 11, 1) + CAST(i AS INTEGER) AS d FROM range(0, 7) t(i)) WHERE dayofweek(d) = 4)
  FROM yrs),
base AS (SELECT e.event, e.date, median(d.units) AS base FROM ev e JOIN daily d
         ON d.day BETWEEN e.date - 21 AND e.date + 21 AND d.day <> e.date GROUP BY e.event, e.date)
SELECT e.event, e.date, CAST(trunc(d.units) AS BIGINT) AS units_that_day, CAST(trunc(b.base) AS BIGINT) AS normal_day,
       round_even(d.units / b.base, 1) + 0.0 AS lift_x
FROM ev e JOIN daily d ON d.day = e.date JOIN base b ON b.event = e.event AND b.date = e.date
WHERE b.base <> 0"""
SQL["yoy_growth"] = with_views(["history"], H) + """,
cmt AS (SELECT category, ym, month(ym) AS m, year(ym) AS y, sum(units) AS units FROM hf GROUP BY category, ym),
yy AS (SELECT category, max(y) AS cur_year, max(y) FILTER (WHERE y < (SELECT max(y) FROM cmt c2 WHERE c2.category = cmt.category)) AS prev_year
       FROM cmt GROUP BY category),
s AS (SELECT y.category, y.prev_year, y.cur_year, sum(p.units) AS p, sum(c.units) AS c
      FROM yy y JOIN cmt p ON p.category = y.category AND p.y = y.prev_year
                JOIN cmt c ON c.category = y.category AND c.y = y.cur_year AND c.m = p.m
      WHERE y.prev_year IS NOT NULL GROUP BY y.category, y.prev_year, y.cur_year)
SELECT category, prev_year, cur_year, CAST(trunc(p) AS BIGINT) AS prev_units, CAST(trunc(c) AS BIGINT) AS cur_units,
       round_even((c - p) / p * 100, 1) + 0.0 AS yoy_pct
FROM s WHERE p > 0"""
SQL["true_velocity"] = with_views(["history"], H) + """,
last AS (SELECT max(day) AS l FROM h),
g AS (SELECT code, sum(CASE WHEN day > l - 30 THEN units ELSE 0 END) AS d30,
             sum(CASE WHEN day > l - 90 THEN units ELSE 0 END) AS d90,
             arg_max(item, day) AS item, arg_max(category, day) AS category
      FROM h, last GROUP BY code)
SELECT code, item, category, round_even(d30 / 30, 2) + 0.0 AS units_day_30, round_even(d90 / 90, 2) + 0.0 AS units_day_90,
       CASE WHEN d90 > 0 THEN round_even((d30 / 30) / (d90 / 90), 2) + 0.0 END AS momentum
FROM g"""
SQL["seasonal_factors"] = with_views(["history"], H, CAT, ITEM) + """
SELECT 'item' AS level, code AS key, least(greatest(jul / jun, 0.7), 1.8) AS factor
FROM iwide WHERE jun > 0 AND jul IS NOT NULL AND code IN (SELECT code FROM ibase)
UNION ALL
SELECT 'category', category, least(greatest(jul / jun, 0.8), 1.5) FROM cseason WHERE jun > 0 AND jul IS NOT NULL"""
