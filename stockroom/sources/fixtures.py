"""Domain tables derived from the driver's generic tables.

The engine's operators work on retail tables (store-level inventory snapshot, daily sales
history, reference lists ...). The driver ships TPC-H-like tables instead, so each domain
table is defined here as one SELECT over them. The same text runs on Spark (placeholders
bound to DataFrames with ``spark.sql(text, **frames)``) and on the oracle engine (placeholders
replaced by table or CTE names), so both sides see identical inputs.

All of them scale with the raw tables: every view reads whole tables, and the per-row
expressions (``pk % 23 = 0`` etc.) only decide *which* products carry a list flag, the way a
buyer's list would.
"""

from __future__ import annotations

import re

AS_OF = "2001-06-30"

# name -> SELECT text; {name} placeholders reference raw tables or earlier views.
VIEWS: dict[str, str] = {}

VIEWS["inventory"] = """
WITH s AS (
  SELECT l_partkey AS pk, s_nationkey AS nk, min(s_name) AS sup,
         sum(CASE WHEN l_shipdate > TIMESTAMP '2001-05-31 00:00:00' THEN l_quantity ELSE 0 END) AS u30,
         sum(CASE WHEN l_shipdate > TIMESTAMP '2001-04-01 00:00:00' THEN l_quantity ELSE 0 END) AS u90,
         sum(CASE WHEN l_shipdate <= TIMESTAMP '2000-06-30 00:00:00' THEN l_quantity ELSE 0 END) AS u_ly4
  FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
  WHERE l_shipdate > TIMESTAMP '2000-06-02 00:00:00' AND l_shipdate <= TIMESTAMP '2001-06-30 00:00:00'
  GROUP BY l_partkey, s_nationkey)
SELECT n_name AS store, concat('00', cast(900000000000 + pk AS string)) AS code,
       cast(900000000000 + pk AS string) AS code_key,
       concat(p_name, ' ', cast(pk AS string), ' ', cast((pk % 4 + 1) * 5 AS string), 'mg') AS item,
       p_type AS department, p_brand AS category,
       CASE WHEN pk % 37 = 0 THEN concat(sup, ' Discontinued') ELSE sup END AS supplier,
       cast((pk * 31 + nk * 17) % 61 - 3 AS double) AS on_hand, u30, u90, u_ly4,
       cast(pk % 12 AS double) AS case_pack,
       CASE WHEN pk % 10 = 0 THEN 0.0E0 WHEN pk % 53 = 0 THEN p_retailprice + 10
            ELSE p_retailprice - 350 END AS avg_cost,
       CASE WHEN pk % 20 = 0 THEN 0.0E0 ELSE p_retailprice - 340 END AS supplier_cost,
       p_retailprice AS price,
       CASE pk % 9 WHEN 0 THEN 0.0E0 WHEN 1 THEN NULL ELSE p_retailprice - 5 END AS club_price, pk * 100 + nk AS ingest_row
FROM s JOIN {nation} ON n_nationkey = nk JOIN {part} ON p_partkey = pk
"""

VIEWS["history"] = """
SELECT cast(l_shipdate AS date) AS day, cast(900000000000 + l_partkey AS string) AS code, p_brand AS category,
       min(p_name) AS item, sum(l_quantity) AS units, count(*) AS lines
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
GROUP BY cast(l_shipdate AS date), l_partkey, p_brand
"""

VIEWS["sales_lines"] = """
SELECT event_id, ts, concat('STORE_', cast(user_id % 16 AS string)) AS store,
       event_type AS department, concat('P', cast(user_id % 40 AS string)) AS code,
       concat('product ', cast(user_id % 40 AS string), ' ', cast(event_id % 3 AS string)) AS description,
       1 AS quantity, cast(value AS decimal(18,2)) AS total
FROM {events}
"""

VIEWS["ad_list"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key,
       CASE WHEN p_partkey % 2 = 0 THEN 'weekly' ELSE 'sunday' END AS kind,
       CASE WHEN p_partkey % 2 = 0 THEN 4.5E0 ELSE 8.0E0 END AS target_wos, p_partkey AS list_row
FROM {part} WHERE p_partkey % 23 = 0
UNION ALL
SELECT cast(900000000000 + p_partkey AS string), 'weekly', 6.0E0, 10000000 + p_partkey
FROM {part} WHERE p_partkey % 92 = 0
"""

VIEWS["remove_list"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key FROM {part} WHERE p_partkey % 29 = 0
"""

VIEWS["new_list"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key FROM {part} WHERE p_partkey % 31 = 0
"""

VIEWS["buy_months"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key, cast(1 + p_partkey % 12 AS int) AS m
FROM {part} WHERE p_partkey % 7 = 0
UNION
SELECT cast(900000000000 + p_partkey AS string), cast(1 + (p_partkey + 5) % 12 AS int)
FROM {part} WHERE p_partkey % 14 = 0
"""

VIEWS["par_list"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key, n_name AS store,
       cast(1 + (p_partkey + n_nationkey) % 6 AS double) AS cases, p_partkey * 100 + n_nationkey AS list_row
FROM {part} CROSS JOIN {nation} WHERE p_partkey % 41 = 0
UNION ALL
SELECT cast(900000000000 + p_partkey AS string), concat(' ', lower(n_name)), cast(3 + n_nationkey % 2 AS double),
       1000000000 + p_partkey * 100 + n_nationkey
FROM {part} CROSS JOIN {nation} WHERE p_partkey % 123 = 0 AND n_nationkey % 3 = 0
"""

VIEWS["market_price"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice * (75 + p_partkey % 50) / 100 END AS market,
  CASE WHEN p_partkey % 5 = 0 THEN p_retailprice * (80 + p_partkey % 37) / 100 END AS comp_a,
  CASE WHEN p_partkey % 11 = 0 THEN p_retailprice * (80 + p_partkey % 41) / 100 END AS comp_b,
  p_partkey AS list_row
FROM {part}
UNION ALL
SELECT cast(900000000000 + p_partkey AS string), p_retailprice, p_retailprice * 0.7E0, NULL, 10000000 + p_partkey
FROM {part} WHERE p_partkey % 15 = 0
"""

VIEWS["deals"] = """
SELECT cast(900000000000 + p_partkey AS string) AS code_key, p_name AS item, p_brand AS category,
  cast(1 + p_partkey % 12 AS int) AS units_case, (p_retailprice - 350) * (1 + p_partkey % 12) AS case_cost,
  (p_retailprice - 350) * (100 - p_partkey % 31) / 100 AS net_unit, cast(p_partkey % 4 AS double) AS min_cases,
  p_retailprice AS retail, p_partkey AS list_row
FROM {part} WHERE p_partkey % 6 = 0
UNION ALL
SELECT cast(900000000000 + p_partkey AS string), p_name, p_brand, 6, (p_retailprice - 350) * 6,
  (p_retailprice - 350) * 0.85E0, 2.0E0, p_retailprice, 10000000 + p_partkey
FROM {part} WHERE p_partkey % 24 = 0
"""

VIEWS["po_lines"] = """
SELECT l_orderkey AS ref, s_name AS vendor, n_name AS location, cast(l_partkey AS string) AS code,
  p_type AS department, p_brand AS category,
  CASE l_linestatus WHEN 'O' THEN 'Receiving' ELSE 'Inventory Received' END AS status,
  l_quantity AS cases_ordered,
  CASE WHEN l_returnflag = 'R' THEN l_quantity - 1 ELSE l_quantity END AS cases_received,
  CASE l_linenumber % 3 WHEN 0 THEN 'Wine & Spirits' WHEN 1 THEN 'Fine WINE team' END AS team,
  cast(l_shipdate AS date) AS created
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON n_nationkey = s_nationkey
  JOIN {part} ON p_partkey = l_partkey
"""

# Buyer decision log (append-only, id order). Set events carry their own action/qty/note;
# an `error` event stands for an undo of the latest earlier set event of the same key
# (target_id). Like the original log, every set event stores the state it replaced
# (prev_*): the latest earlier set event of the key that was not undone.
VIEWS["change_log"] = """
WITH e AS (
  SELECT event_id AS id, ts, CASE WHEN user_id % 2 = 0 THEN 'THC' ELSE 'Wine' END AS dept,
    concat('item ', cast(user_id AS string)) AS item,
    CASE event_type WHEN 'click' THEN 'qty' WHEN 'view' THEN 'approve' WHEN 'purchase' THEN 'skip'
                    WHEN 'error' THEN 'undo' ELSE 'fix' END AS action,
    CASE WHEN event_type = 'click' THEN cast(event_id % 50 AS int) END AS qty,
    CASE WHEN event_type = 'signup' THEN concat('note ', cast(event_id AS string)) END AS note
  FROM {events}),
t AS (
  SELECT e.*, CASE WHEN action = 'undo' THEN max(CASE WHEN action <> 'undo' THEN id END)
    OVER (PARTITION BY dept, item ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS target_id
  FROM e),
g AS (SELECT DISTINCT target_id AS undone_id FROM t WHERE target_id IS NOT NULL),
p AS (
  SELECT t.*, max(CASE WHEN t.action <> 'undo' AND g.undone_id IS NULL THEN t.id END)
    OVER (PARTITION BY t.dept, t.item ORDER BY t.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_id
  FROM t LEFT JOIN g ON g.undone_id = t.id)
SELECT p.id, p.ts, p.dept, p.item, p.action, p.qty, p.note, p.target_id,
  CASE WHEN p.action <> 'undo' THEN q.action END AS prev_action,
  CASE WHEN p.action <> 'undo' THEN q.qty END AS prev_qty,
  CASE WHEN p.action <> 'undo' THEN q.note END AS prev_note
FROM p LEFT JOIN t q ON q.id = p.prev_id
"""

# Buyer decisions on order lines, as the decision state holds them: one per (dept, item), keys in
# any case and spacing, quantities as text (some not numbers).
VIEWS["order_decisions"] = """
SELECT CASE lower(p_type) WHEN 'small' THEN ' thc' WHEN 'large' THEN 'BEER' WHEN 'medium' THEN 'Wine '
            WHEN 'standard' THEN 'spirits' ELSE 'Other' END AS dept,
       upper(concat(p_name, ' ', cast(p_partkey AS string), ' ', cast((p_partkey % 4 + 1) * 5 AS string), 'mg')) AS item,
       CASE p_partkey % 5 WHEN 0 THEN 'skip' WHEN 1 THEN 'qty' WHEN 2 THEN 'approve' WHEN 3 THEN 'fix' ELSE 'qty' END AS action,
       CASE p_partkey % 5 WHEN 1 THEN cast(p_partkey % 90 - 5 AS string) WHEN 4 THEN 'a few' END AS qty,
       CASE WHEN p_partkey % 5 = 3 THEN concat('check ', p_brand) END AS note
FROM {part} WHERE p_partkey % 3 <> 0
"""

# Product catalog: one row per distinct product listing seen in the snapshot. A code may be
# listed several times (one per supplier), so the "last listing wins" rules have work to do.
VIEWS["catalog"] = """
SELECT code, code_key, item, department, category, supplier, case_pack, price, avg_cost AS unit_cost,
       min(ingest_row) AS cat_row
FROM {inventory}
GROUP BY code, code_key, item, department, category, supplier, case_pack, price, avg_cost
"""

# An uploaded price sheet: every catalog listing, its code written three ways
# (dashed, plain with zeros, or missing so the name fallback is used) and a price 5 % off.
VIEWS["upload"] = """
SELECT CASE cat_row % 3 WHEN 0 THEN concat(substr(code, 1, 4), '-', substr(code, 5, 4), '-', substr(code, 9))
                        WHEN 1 THEN code ELSE '' END AS up_code,
       CASE WHEN cat_row % 3 = 2 THEN upper(item) ELSE concat('Listing ', cast(cat_row AS string)) END AS up_item,
       price * 0.95 AS up_price, cat_row AS up_row
FROM {catalog}
"""

# The same price sheet as it is uploaded: a title, a blank row, a header row, then text cells with
# "$" prices. No header names the code.
VIEWS["upload_sheet"] = """
SELECT CAST(0 AS BIGINT) AS row_idx, 'Spring price sheet' AS c0, CAST(NULL AS string) AS c1, CAST(NULL AS string) AS c2
UNION ALL SELECT 1, '', '', ''
UNION ALL SELECT 2, 'Ref', ' Product  Title', 'Unit  Cost'
UNION ALL SELECT up_row + 10, up_code, up_item, concat('$', cast(cast(floor(up_price) AS bigint) AS string), '.50 ea') FROM {upload}
"""

# The buyer master as a header-less sheet (the columns in use), with deal months in the deal text.
VIEWS["buyer_sheet"] = """
SELECT p_partkey + 2 AS row_idx, cast(900000000000 + p_partkey AS string) AS c8, p_name AS c9, p_brand AS c12,
       cast(p_partkey % 12 + 1 AS string) AS c15,
       CASE p_partkey % 4 WHEN 0 THEN concat('Case deal JAN/', substr(p_type, 1, 3), '/Mar') WHEN 1 THEN 'sond only' WHEN 2 THEN 'nan' ELSE 'May, june' END AS c16,
       cast(p_size AS string) AS c25, cast(p_retailprice AS string) AS c27
FROM {part}
"""

# A folder listing of report files, dated in two ways or not at all; lock files in between.
VIEWS["file_listing"] = """
SELECT concat('/reports/', cast(o_orderkey AS string)) AS path,
       concat(CASE WHEN o_orderkey % 13 = 0 THEN '~$' ELSE '' END, 'Sales Report',
              CASE o_orderkey % 3 WHEN 0 THEN concat(' 2001-', cast(o_orderkey % 12 + 1 AS string), '-', cast(o_orderkey % 28 + 1 AS string))
                                  WHEN 1 THEN concat(' ', cast(o_orderkey % 12 + 1 AS string), '.', cast(o_orderkey % 28 + 1 AS string), '.02') ELSE '' END,
              '.xlsx') AS name,
       o_orderdate AS mtime, o_orderkey % 2 AS folder
FROM {orders}
"""

# Ad lines as marketing writes them: a product with a slash pair naming the next product
# by a shortened name, or a whole-brand line ("All <first word>"); one line per listed part.
VIEWS["ad_lines"] = """
SELECT p_partkey AS line_id,
       CASE WHEN p_partkey % 46 = 0 THEN concat('All ', split_part(p_name, ' ', 1), ' (all types)')
            ELSE concat(p_name, ' ', cast(p_partkey AS string), ' / ', substr(p_name, 1, 4), ' ',
                        cast(p_partkey + 1 AS string)) END AS raw,
       CASE WHEN p_partkey % 2 = 0 THEN 'weekly' ELSE 'sunday' END AS kind
FROM {part} WHERE p_partkey % 23 = 0
"""

# A list tab as the buyer tool shows it: every catalog listing as text, categories written
# in mixed case and spacing (the facet dedupe has work to do), prices as "$" text.
VIEWS["explore_tab"] = """
SELECT cat_row AS row_id, code AS upc, item AS description, department,
       CASE cat_row % 3 WHEN 0 THEN upper(category) WHEN 1 THEN replace(category, '#', ' #')
                        ELSE category END AS category,
       supplier, cast(cast(case_pack AS bigint) AS string) AS units_case,
       concat('$', cast(cast(price AS decimal(12,2)) AS string)) AS retail
FROM {catalog}
"""

# A block of order lines pasted from a sheet: a header line, then one tab-separated line
# per shipped line - some with 0, blank or non-numeric cases, all short of the 11 columns.
VIEWS["po_paste"] = """
SELECT CAST(0 AS BIGINT) AS line_no,
       concat_ws(chr(9), 'CasePrice', 'CaseQuantity', 'CasesOrdered', 'Date', 'Location', 'ProductCode',
                 'ReorderNumber', 'Supplier', 'Description') AS line
UNION ALL
SELECT l_orderkey * 8 + l_linenumber AS line_no,
       concat_ws(chr(9), cast(p_size * 3 + l_linenumber AS string), cast(p_size AS string),
                 CASE l_linenumber WHEN 7 THEN '0' WHEN 6 THEN '' WHEN 5 THEN 'n/a'
                      ELSE cast(cast(l_quantity AS bigint) AS string) END,
                 '', n_name, cast(l_partkey AS string), '', s_name, p_name) AS line
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {supplier} ON s_suppkey = l_suppkey
  JOIN {nation} ON n_nationkey = s_nationkey
"""

# Price-reference rows as tabs repeat them: one row per listing, each field filled on only
# some rows of a code (the per-field "first non-empty" rule has to gather them).
VIEWS["cost_reference_rows"] = """
SELECT code_key, ingest_row, department,
       CASE WHEN ingest_row % 100 % 3 = 0 THEN cast(cast(avg_cost AS decimal(12,2)) AS string) ELSE '' END AS buyer_cost,
       CASE WHEN ingest_row % 100 % 4 = 1 THEN concat('case of ', cast(cast(case_pack AS bigint) AS string)) END AS deal,
       CASE WHEN ingest_row % 100 % 5 = 2 THEN concat(cast(ingest_row % 12 + 1 AS string), '|', cast((ingest_row + 6) % 12 + 1 AS string))
            ELSE '' END AS buy_months
FROM {inventory}
"""

# The weekly-ad workbook sheet: one block per ad week - a header row naming the in-store ad
# with its date, a "Type / Item" row, then one row per advertised product (extra spaces in
# the names, as typed). Rows before the first header belong to no week.
VIEWS["ad_sheet"] = """
SELECT CAST(floor(p_partkey / 40) AS BIGINT) * 1000 AS row_idx, 'In-Store Ad' AS c0, 'week of' AS c1,
       CAST(NULL AS string) AS c2, DATE '2000-01-03' + CAST(floor(p_partkey / 40) * 7 AS INT) AS c_date
FROM {part} WHERE p_partkey % 40 = 0
UNION ALL
SELECT CAST(floor(p_partkey / 40) AS BIGINT) * 1000 + 1, '', 'Type', 'Item', CAST(NULL AS date)
FROM {part} WHERE p_partkey % 40 = 0
UNION ALL
SELECT CAST(floor(p_partkey / 40) AS BIGINT) * 1000 + 2 + p_partkey % 40, 'weekly', p_type,
       concat(p_name, '  ', cast(p_size AS string), 'mg '), CAST(NULL AS date)
FROM {part}
"""

# Landed pages of the sales report: one JSON document per page; items come wrapped
# ({"item": {...}}) or bare, and some carry a blank product code.
VIEWS["ad_sheets"] = """
SELECT p_brand AS sheet, CAST(floor(p_partkey / 20) AS BIGINT) * 10 AS row_idx, 'In-Store Ad' AS c0, 'week of' AS c1, min(p_name) AS c2,
       DATE '1997-01-06' + CAST(floor(p_partkey / 40) * 35 % 1750 + CAST(substr(p_brand, 7, 1) AS INT) AS INT) AS c_date
FROM {part} GROUP BY p_brand, floor(p_partkey / 20), floor(p_partkey / 40)
UNION ALL
SELECT p_brand, CAST(floor(p_partkey / 20) AS BIGINT) * 10 + 1, 'Content due', 'no date yet', min(p_name), CAST(NULL AS date)
FROM {part} GROUP BY p_brand, floor(p_partkey / 20)
"""

# 31 workbooks: header rows, column orders, names and missing columns differ; header blocks repeat
VIEWS["workbooks"] = """
WITH b AS (
  SELECT p_partkey AS pk, p_partkey % 31 AS k, CAST(floor(p_partkey / 31) AS BIGINT) AS q, p_name, p_size, p_retailprice,
         cast(900000000000 + CASE WHEN p_partkey % 9 = 4 AND p_partkey > 31 THEN p_partkey - 31 WHEN p_partkey % 17 = 5 THEN p_partkey - 1 ELSE p_partkey END AS string) AS code,
         CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat(cast(p_partkey % 50 AS string), '.25') END AS net,
         cast(p_partkey % 40 + 1 AS string) AS cs, CASE WHEN p_partkey % 13 = 0 THEN '0' WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE cast(p_partkey % 8 + 1 AS string) END AS units,
         CASE p_partkey % 4 WHEN 0 THEN ' Case deal ' WHEN 1 THEN 'nan' WHEN 2 THEN '' ELSE concat('Deal ', cast(p_size AS string)) END AS deal,
         CASE p_partkey % 5 WHEN 0 THEN 'JAN/Mar' WHEN 1 THEN 'sond' WHEN 2 THEN 'ALL' WHEN 3 THEN '' ELSE 'nan' END AS bm
  FROM {part}),
f AS (SELECT k, concat('/books/', CASE k % 3 WHEN 0 THEN 'Wine' WHEN 1 THEN 'Beer' ELSE 'Spirits' END, ' ', cast(100 + k AS string), '.xlsx') AS file,
             CASE k % 3 WHEN 0 THEN 'Wine' WHEN 1 THEN 'BEER list' ELSE 'Prices' END AS dsheet, min(pk) AS least
      FROM b GROUP BY k)
SELECT file, 'Cover' AS sheet, 0 AS sheet_no, CAST(0 AS BIGINT) AS row_idx, split(concat('Product UPC list ', cast(k AS string)), '~') AS cells FROM f
UNION ALL
SELECT file, 'Other', 1, CAST(0 AS BIGINT), split('Product UPC~Net/Unit~c~d~e~f~g~h~i~j~k~l~m', '~') FROM f
UNION ALL
SELECT file, 'Other', 1, CAST(1 AS BIGINT), split(concat(cast(800000000000 + k AS string), '~9.99'), '~') FROM f
UNION ALL
SELECT file, dsheet, 2, CAST(0 AS BIGINT), split('Buyer~sheet', '~') FROM f WHERE k % 4 > 0
UNION ALL
SELECT file, dsheet, 2, CAST(k % 4 AS BIGINT), split(CASE
         WHEN k % 10 = 9 THEN 'Product UPC~Product Description~Units/Case~Deal Description~x~y~z~a~b~c~d~Product UPC'
         WHEN k % 2 = 0 THEN 'Product UPC~Product Description~Units/Case~Deal Description~Net/Unit~Net Case Cost~Buy Months (if appl.)~a~b~c~d~Product UPC~Net/Unit'
         ELSE ' Deal Description ~Product Description~PRODUCT UPC~Buy Months~Invoice Cost~Units / Case~a~b~c~d~e~Product UPC' END, '~')
FROM f
UNION ALL
SELECT f.file, f.dsheet, 2, f.k % 4 + 1 + b.q, split(CASE
         WHEN f.k % 2 = 0 THEN concat(code, '~', p_name, '~', units, '~', deal, '~', net, '~', cs, '~', bm, '~~~~~', code, '~77')
         ELSE concat(deal, '~', p_name, '~', code, '~', bm, '~', cs, '~', units) END, '~')
FROM b JOIN f ON b.k = f.k
UNION ALL
SELECT file, 'Remove', 3, CAST(1 AS BIGINT), split('note~The Product UPC~x~Product UPC', '~') FROM f
UNION ALL
SELECT file, 'Remove', 3, CAST(CASE WHEN k % 6 = 5 THEN 6 ELSE 1 + k % 3 END AS BIGINT), split('~~Product Description', '~') FROM f WHERE k % 3 > 0
UNION ALL
SELECT f.file, 'Remove', 3, b.q + 10, split(concat('x~', code, '~', CASE WHEN pk % 23 = 0 THEN 'NaN' WHEN pk % 29 = 0 THEN ' ' ELSE p_name END), '~')
FROM b JOIN f ON b.k = f.k WHERE pk % 2 = 0
UNION ALL
SELECT file, 'Stock A', 4, CAST(0 AS BIGINT), split('OH~30D~90D~Product Description~TOH', '~') FROM f
UNION ALL
SELECT file, 'Stock B', 5, CAST(0 AS BIGINT), split(CASE WHEN k % 2 = 0 THEN 'Product Description~Location Name~OH~30D~90D~PM' ELSE 'Product description~Location Name~OH~30D~90D~PM' END, '~') FROM f
UNION ALL
SELECT f.file, 'Stock A', 4, b.q + 1, split(concat(cast(p_size AS string), '~', units, '~', cs, '~', p_name, '~1'), '~') FROM b JOIN f ON b.k = f.k
UNION ALL
SELECT f.file, 'Stock B', 5, b.q + 1, split(concat(' ', p_name, '~STORE_', cast(pk % 5 AS string), '~', cast(p_size AS string), '~', units), '~') FROM b JOIN f ON b.k = f.k
"""

VIEWS["report_pages"] = """
SELECT event_id AS page,
       concat('{{"estimatedTotal": 1, "items": [',
              CASE WHEN event_id % 2 = 0 THEN '{{"item": ' ELSE '' END,
              '{{"locationName": "', concat('STORE_', cast(user_id % 16 AS string)),
              '", "department": "', event_type,
              '", "productCode": "', CASE WHEN event_id % 17 = 0 THEN ' ' ELSE concat('P', cast(user_id % 40 AS string)) END,
              '", "quantity": 1, "total": ', cast(cast(value AS decimal(18,2)) AS string), '}}',
              CASE WHEN event_id % 2 = 0 THEN '}}' ELSE '' END, ']}}') AS body
FROM {events}
"""

# Whole paged reports: list pages and object pages, with and without a total (some below the landed pages), empty pages
# in the middle, pages that landed twice, wrapped, bare and null items.
VIEWS["report_pulls"] = """
SELECT e.event_id % 97 AS report, CAST(floor(e.event_id / 97) AS BIGINT) AS page,
       concat(CASE WHEN e.event_id % 97 % 3 = 0 THEN '['
                   WHEN e.event_id % 97 % 3 = 1 THEN concat('{{"estimatedTotal": ', cast(500 * (e.event_id % 97 % 29) + 1 AS string), ', "items": [')
                   ELSE '{{"items": [' END,
              CASE WHEN (e.event_id % 97 * 7 + floor(e.event_id / 97)) % 61 = 5 THEN ''
                   ELSE concat(CASE WHEN e.event_id % 2 = 0 THEN '{{"item": ' ELSE '' END,
                        CASE WHEN e.event_id % 154 = 0 THEN 'null'
                             ELSE concat('{{"locationName": "STORE_', cast(e.user_id % 16 AS string), '", "department": "', e.event_type,
                                         '", "productCode": "', CASE WHEN e.event_id % 17 = 0 THEN ' ' ELSE concat('P', cast(e.user_id % 40 AS string)) END,
                                         '", "quantity": 1, "total": ', cast(cast(e.value AS decimal(18,2)) AS string), '}}') END,
                        CASE WHEN e.event_id % 2 = 0 THEN '}}' ELSE '' END) END,
              CASE WHEN e.event_id % 97 % 3 = 0 THEN ']' ELSE ']}}' END) AS body
FROM {events} e JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) twice ON twice.k = 0 OR e.event_id % 5 = 0
"""

# Lists that repeat keys; a later row replaces an earlier one (by list_row).
LAST_ROW_WINS = {"ad_list": "code_key", "par_list": "code_key, lower(trim(store))", "deals": "code_key"}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def dependencies(name: str) -> list[str]:
    return _PLACEHOLDER.findall(VIEWS[name])


def as_cte_sql(names: list[str]) -> str:
    """``WITH`` clause defining the named views (and what they need) for the oracle engine. A list
    that repeats keys is there as ``<name>_rows`` and, last row per key only, under its name."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in VIEWS or n in order:
            return
        for d in dependencies(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    # {name} binds a frame on Spark; literal braces are written doubled, as spark.sql expects
    parts = []
    for n in order:
        text = _PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[n]).replace("{{", "{").replace("}}", "}").strip()
        if n in LAST_ROW_WINS:
            parts.append(f"{n}_rows AS ({text})")
            text = f"SELECT * FROM {n}_rows QUALIFY row_number() OVER (PARTITION BY {LAST_ROW_WINS[n]} ORDER BY list_row DESC) = 1"
        parts.append(f"{n} AS ({text})")
    return ("WITH " + ",\n".join(parts)) if parts else ""
