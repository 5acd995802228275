"""Shared SQL fragments for the oracle queries."""

from __future__ import annotations

from stockroom import config
from stockroom.sources.fixtures import as_cte_sql


def dept_case(col: str = "department", groups=None) -> str:
    groups = groups or config.FIXTURE_DEPARTMENTS
    arms = []
    for label, values in groups.items():
        vs = ", ".join(f"'{v}'" for v in values)
        arms.append(f"WHEN lower(trim(coalesce({col}, ''))) IN ({vs}) THEN '{label}'")
    return "CASE " + " ".join(arms) + " END"


NONRETAIL = ", ".join(f"'{x}'" for x in config.NON_RETAIL_LOCATIONS)

# Cleaned, scoped snapshot with cost cascade (S01 + P01 + P02 + P04).
INV = f"""inv AS (
  SELECT store, code, code_key, item, department, category, supplier,
         coalesce(on_hand, 0) AS on_hand, coalesce(u30, 0) AS u30, coalesce(u90, 0) AS u90,
         coalesce(u_ly4, 0) AS u_ly4, coalesce(case_pack, 0) AS case_pack,
         coalesce(avg_cost, 0) AS avg_cost, coalesce(supplier_cost, 0) AS supplier_cost,
         coalesce(price, 0) AS price, price AS price_raw, club_price, ingest_row,
         CASE WHEN coalesce(avg_cost, 0) > 0 THEN avg_cost
              WHEN coalesce(supplier_cost, 0) > 0 THEN supplier_cost ELSE 0.0 END AS cost,
         {dept_case()} AS dept
  FROM inventory WHERE trim(store) NOT IN ({NONRETAIL})),
sinv AS (SELECT * FROM inv WHERE dept IS NOT NULL)"""

# Per-store need with the par floor (Q01 + J04).
NEED = """need0 AS (
  SELECT s.*, u30 * 7 / 30 AS vel, greatest(on_hand, 0) AS oh_need,
         coalesce(p.cases, 0) AS par_cases, coalesce(p.cases, 0) > 0 AS has_par
  FROM sinv s LEFT JOIN (SELECT * FROM par_list WHERE cases > 0) p
    ON s.code_key = p.code_key AND lower(trim(s.store)) = lower(trim(p.store))),
needs AS (
  SELECT *, greatest(greatest(vel * 4 - oh_need, 0),
                     greatest(par_cases * CASE WHEN case_pack = 0 THEN 1 ELSE case_pack END - oh_need, 0)) AS need
  FROM need0)"""

# Transfer allocation as a recursive walk, one level per receiver.
TRANSFER = """st AS (
  SELECT dept, item, store, on_hand AS oh, vel, need,
         CAST(greatest(round_even(on_hand - vel * 4, 0), 0) AS BIGINT) AS surplus,
         CAST(greatest(round_even(need, 0), 0) AS BIGINT) AS need_r,
         CASE WHEN vel > 0 THEN on_hand / vel ELSE 1e9 END AS wos
  FROM needs),
recv AS (
  SELECT dept, item, store, oh, wos, need_r,
         row_number() OVER (PARTITION BY dept, item ORDER BY wos, store) AS k
  FROM st WHERE need_r > 0),
walk(dept, item, k, donor, avail, take, before) AS (
  SELECT dept, item, CAST(0 AS BIGINT), store, surplus, CAST(0 AS BIGINT), surplus FROM st WHERE surplus >= 4
  UNION ALL
  SELECT dept, item, k, donor,
         avail - CASE WHEN elig AND need_r - prev >= 4 THEN least(need_r - prev, avail) ELSE 0 END,
         CASE WHEN elig AND need_r - prev >= 4 THEN least(need_r - prev, avail) ELSE 0 END,
         avail
  FROM (
    SELECT w.dept, w.item, w.k + 1 AS k, w.donor, w.avail, v.need_r,
           (w.avail >= 4 AND w.donor <> v.store) AS elig,
           coalesce(sum(CASE WHEN w.avail >= 4 AND w.donor <> v.store THEN w.avail ELSE 0 END)
             OVER (PARTITION BY w.dept, w.item ORDER BY w.avail DESC, w.donor
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
    FROM walk w JOIN recv v ON v.dept = w.dept AND v.item = w.item AND v.k = w.k + 1) x),
got AS (
  SELECT dept, item, k, CAST(sum(take) AS BIGINT) AS got,
         string_agg(donor || ' (' || CAST(take AS VARCHAR) || ')', ', ' ORDER BY before DESC, donor) AS from_stores
  FROM walk WHERE k > 0 AND take > 0 GROUP BY dept, item, k),
moves AS (
  SELECT r.dept, r.item,
         CASE WHEN r.oh <= 0 THEN 'STOCKOUT' WHEN r.wos < 2 THEN 'Low <2wk' ELSE 'Top-up' END AS priority,
         r.store AS to_store, CAST(trunc(r.oh) AS BIGINT) AS to_oh,
         round_even(least(r.wos, 99.0), 1) + 0.0 AS to_wos, g.got AS transfer_in, g.from_stores,
         r.need_r - g.got AS then_buy
  FROM recv r JOIN got g ON g.dept = r.dept AND g.item = r.item AND g.k = r.k),
titems AS (
  SELECT s.dept, s.item, CAST(sum(s.need_r) AS BIGINT) AS gross_need, CAST(coalesce(max(m.t), 0) AS BIGINT) AS transfer,
         CAST(sum(s.need_r) - coalesce(max(m.t), 0) AS BIGINT) AS net_buy
  FROM st s LEFT JOIN (SELECT dept, item, sum(transfer_in) AS t FROM moves GROUP BY dept, item) m
    ON m.dept = s.dept AND m.item = s.item
  GROUP BY s.dept, s.item)"""


def norm_code(c: str) -> str:
    d = f"regexp_replace(regexp_replace(trim(CAST({c} AS VARCHAR)), '\\.0$', ''), '[^0-9]', '', 'g')"
    return f"(CASE WHEN ltrim({d}, '0') = '' THEN {d} ELSE ltrim({d}, '0') END)"


def with_views(views: list[str], *ctes: str) -> str:
    """WITH clause: fixture views first, then the given CTE fragments."""
    head = as_cte_sql(views)
    body = ",\n".join(ctes)
    kw = "WITH RECURSIVE " if "walk(" in body else "WITH "
    if head:
        head = kw + head[len("WITH "):]
        return head + (",\n" + body if body else "")
    return kw + body if body else ""
