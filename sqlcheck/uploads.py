"""Oracle SQL: uploaded sheets, buyer master, list tabs, report folders, sheets read back."""

from . import matching, order
from .brief import SQL as BRIEF
from .brief import TERMS
from .common import norm_code, with_views
from .explore import brand_sql, potency_sql

SQL = {}
SQL["upload_compare"] = matching.SQL["sheet_compare"].replace("FROM upload)", """FROM (
  SELECT up_code, up_item, floor(up_price) + 0.5 AS up_price, up_row + 10 AS up_row FROM upload) up)""")
SQL["upload_money"] = with_views(["upload"]) + """
SELECT 'Line Amount' AS header, true AS guessed, count(*) AS rows, CAST(sum((floor(up_price) + 0.5) * 4) AS DOUBLE) AS total FROM upload"""
_STEMS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_HITS = ", ".join(f"CASE WHEN contains(s, '{m}') OR ({i} >= 9 AND contains(s, 'sond')) THEN '{i}' END" for i, m in enumerate(_STEMS, 1))
SQL["buyer_master"] = with_views(["buyer_sheet"]) + f"""
SELECT row_idx, {norm_code('c8')} AS code, c9 AS description, c12 AS category, CAST(c15 AS DOUBLE) AS units_case, CAST(c25 AS DOUBLE) AS net_unit,
       CAST(c27 AS DOUBLE) AS retail, CASE WHEN s = 'nan' THEN '' ELSE concat_ws('|', {_HITS}) END AS months
FROM (SELECT *, lower(trim(c16)) AS s FROM buyer_sheet) b WHERE row_idx >= 3"""
SQL["tidy_tab"] = with_views(["explore_tab"]) + """
SELECT supplier AS "Distributor", description, row_id AS row_idx, upc, retail FROM explore_tab WHERE trim(coalesce(upc, '')) <> ''"""
SQL["tab_items"] = with_views(["explore_tab"]) + f"""
SELECT {norm_code('upc')} AS code, arg_min(trim(description), row_id) AS item FROM explore_tab
WHERE {norm_code('upc')} <> '' AND trim(coalesce(description, '')) NOT IN ('', 'nan') GROUP BY 1"""
SQL["report_files"] = with_views(["file_listing"]) + """,
d AS (SELECT *, CASE WHEN regexp_matches(name, '20[0-9]{2}-') THEN CAST(regexp_extract(name, '(20[0-9]{2}-[0-9]+-[0-9]+)', 1) AS DATE)
                     WHEN regexp_matches(name, ' [0-9]+[.]') THEN make_date(2002,
                          CAST(regexp_extract(name, ' ([0-9]+)[.]', 1) AS INT), CAST(regexp_extract(name, '[.]([0-9]+)[.]02', 1) AS INT))
                     ELSE CAST(mtime AS DATE) END AS data_date FROM file_listing WHERE NOT starts_with(name, '~$'))
SELECT data_date, path, name FROM d QUALIFY row_number() OVER (PARTITION BY data_date ORDER BY folder, mtime DESC, path, name) = 1"""
SQL["newest_snapshot"] = f"SELECT dept, item, chain_oh, wos FROM ({BRIEF['inventory_snapshot']}) s"
SQL["explore_filtered"] = with_views(["catalog", "deals"], TERMS) + f"""
SELECT cat_row, item, brand, potency, discount FROM (
  SELECT c.cat_row, c.item, {brand_sql('c.item')} AS brand, {potency_sql('c.item')} AS potency, CAST(t.discount_pct AS VARCHAR) AS discount
  FROM catalog c LEFT JOIN terms t ON t.code_key = c.code_key) x
WHERE brand IN ('green', 'green gear', 'blue', 'red', 'hot') AND potency IN (5, 20) AND coalesce(TRY_CAST(discount AS DOUBLE), 0) >= 10"""
SQL["store_orders_written"] = order.SQL["store_orders"]
SQL["vendor_split_files"] = with_views(["po_lines"]) + """
SELECT trim(regexp_replace(coalesce(nullif(trim(vendor), ''), 'Unknown'), '[^A-Za-z0-9_ .-]', '_', 'g')) AS vendor_file, count(*) AS lines,
       sum(cases_ordered) AS cases, min(code) AS first_code
FROM po_lines WHERE status = 'Receiving' AND created > DATE '2001-06-30' - 4 AND trim(coalesce(code, '')) <> '' GROUP BY 1"""
