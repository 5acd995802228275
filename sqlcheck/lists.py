"""Oracle SQL: category report, row flags, PO import, price reference."""

from stockroom.operators.clean import PO_IMPORT_COLUMNS
from stockroom.plans import lists as L

from . import order
from .common import with_views

SQL = {}
_cats = ", ".join(f"'{c.lower()}'" for c in L.REPORT_EXCLUDED_CATEGORIES)
SQL["category_report"] = with_views(["inventory"]) + f"""
SELECT * FROM inventory WHERE lower(trim(department)) = '{L.REPORT_DEPARTMENT}'
  AND lower(trim(category)) NOT IN ({_cats}) AND trim(store) <> '{L.REPORT_EXCLUDED_LOCATION}'"""


def _num(c: str) -> str:
    s = f"regexp_extract(trim(CAST({c} AS VARCHAR)), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?', 0)"
    return f"(CASE WHEN {s} <> '' THEN TRY_CAST({s} AS DOUBLE) END)"


SQL["row_flags"] = f"""SELECT *, coalesce({_num('wos')} > 8, false) AS overstock,
       coalesce(instr(lower(coalesce(CAST(supplier AS VARCHAR), '')), 'discontinued') > 0, false) AS discontinued,
       coalesce({_num('store_oh')} < 0, false) AS negative_oh
FROM ({order.SQL['store_orders']}) s
WHERE NOT coalesce({_num('order_cases')} = 0, false)
  AND NOT (order_cases IS NULL OR coalesce(CAST(order_cases AS VARCHAR), '') = '')"""

_CELLS = ", ".join(f"coalesce(string_split(l, chr(9))[{i + 1}], '') AS {c}" for i, c in enumerate(PO_IMPORT_COLUMNS))
_IMP = with_views(["po_paste"]) + f""",
ne AS (SELECT line_no, replace(line, chr(13), '') AS l FROM po_paste WHERE trim(replace(line, chr(13), '')) <> ''),
fst AS (SELECT line_no, l FROM ne ORDER BY line_no LIMIT 1),
body AS (SELECT * FROM ne WHERE line_no NOT IN (
           SELECT line_no FROM fst
           WHERE TRY_CAST(trim(replace(replace(string_split(l, chr(9))[1], '$', ''), ',', '')) AS DOUBLE) IS NULL)),
cells AS (SELECT line_no, {_CELLS} FROM body),
marked AS (SELECT *, CASE WHEN trim(replace(CasesOrdered, ',', '')) = '' THEN 0.0
                          ELSE TRY_CAST(trim(replace(CasesOrdered, ',', '')) AS DOUBLE) END AS cn FROM cells)"""

_OUT = ", ".join("'" + L.IMPORT_DATE + "' AS Date" if c == "Date" else c for c in PO_IMPORT_COLUMNS)
SQL["po_import"] = _IMP + f"""
SELECT line_no, {_OUT} FROM marked WHERE cn IS NOT NULL AND cn <> 0"""
SQL["po_import_summary"] = _IMP + """
SELECT count(*) FILTER (WHERE cn IS NOT NULL AND cn <> 0) AS rows,
       count(*) FILTER (WHERE cn IS NULL OR cn = 0) AS skipped FROM marked"""

SQL["cost_reference"] = with_views(["cost_reference_rows"]) + """
SELECT code_key,
  arg_min(department, ingest_row) FILTER (WHERE department IS NOT NULL AND trim(department) <> '') AS department,
  arg_min(buyer_cost, ingest_row) FILTER (WHERE buyer_cost IS NOT NULL AND trim(buyer_cost) <> '') AS buyer_cost,
  arg_min(deal, ingest_row) FILTER (WHERE deal IS NOT NULL AND trim(deal) <> '') AS deal,
  arg_min(buy_months, ingest_row) FILTER (WHERE buy_months IS NOT NULL AND trim(buy_months) <> '') AS buy_months
FROM cost_reference_rows GROUP BY code_key"""

from stockroom.sources.fixtures import AS_OF  # noqa: E402

_HEAD_T = "lower(concat_ws(' ', c0, c1, c2))"
_IS_HEAD = f"(instr({_HEAD_T}, 'in-store ad') > 0 OR instr({_HEAD_T}, 'content due') > 0)"
_ITEM = "trim(regexp_replace(CAST(c2 AS VARCHAR), '\\s+', ' ', 'g'))"
SQL["ad_week_items"] = with_views(["ad_sheet"]) + f""",
hd AS (SELECT row_idx, c_date AS ad_date FROM ad_sheet WHERE {_IS_HEAD} AND c_date IS NOT NULL),
pick AS (SELECT coalesce(max(ad_date) FILTER (WHERE ad_date <= DATE '{AS_OF}'), min(ad_date)) AS d FROM hd),
st AS (SELECT hd.row_idx AS s, hd.ad_date FROM hd JOIN pick ON hd.ad_date = pick.d),
en AS (SELECT min(row_idx) AS e FROM hd WHERE row_idx > (SELECT s FROM st))
SELECT (SELECT ad_date FROM st) AS ad_week, row_idx, {_ITEM} AS item
FROM ad_sheet
WHERE row_idx >= (SELECT s FROM st) AND ((SELECT e FROM en) IS NULL OR row_idx < (SELECT e FROM en))
  AND c2 IS NOT NULL AND {_ITEM} <> '' AND lower({_ITEM}) <> 'item' AND NOT {_IS_HEAD}
  AND lower(trim(coalesce(CAST(c1 AS VARCHAR), ''))) <> 'type'"""

_F = [("locationName", "VARCHAR"), ("department", "VARCHAR"), ("category", "VARCHAR"), ("productCode", "VARCHAR"),
      ("description", "VARCHAR"), ("quantity", "DOUBLE"), ("soldPrice", "DOUBLE"), ("total", "DOUBLE")]
_FIELDS = ", ".join(
    (f"json_extract_string(leaf, '$.{n}') AS {n}" if t == "VARCHAR"
     else f"TRY_CAST(json_extract_string(leaf, '$.{n}') AS DOUBLE) AS {n}") for n, t in _F)
SQL["report_items"] = with_views(["report_pages"]) + f""",
it AS (SELECT page, body, unnest(range(0, CAST(json_array_length(body, '$.items') AS BIGINT))) AS pos FROM report_pages),
lf AS (SELECT page, pos, json_extract(body, '$.items[' || CAST(pos AS VARCHAR) || ']') AS j FROM it),
lf2 AS (SELECT page, pos, coalesce(json_extract(j, '$.item'), j) AS leaf FROM lf),
rec AS (SELECT page, pos, {_FIELDS} FROM lf2)
SELECT * FROM rec WHERE trim(coalesce(productCode, '')) <> ''"""

SQL["report_lines"] = with_views(["report_pulls"]) + f""",
pg AS (SELECT report, page, min(body) AS body FROM report_pulls GROUP BY 1, 2),
arr AS (SELECT report, page, CASE WHEN json_type(body) = 'ARRAY' THEN body::JSON ELSE json_extract(body, '$.items') END AS items,
               CASE WHEN json_type(body) = 'OBJECT' THEN TRY_CAST(json_extract_string(body, '$.estimatedTotal') AS BIGINT) END AS total FROM pg),
el AS (SELECT report, page, i, json_extract(items, '$[' || CAST(i AS VARCHAR) || ']') AS j
       FROM (SELECT report, page, items, unnest(range(0, CAST(json_array_length(items) AS BIGINT))) AS i FROM arr)),
ok AS (SELECT report, page, i, CASE WHEN json_exists(j, '$.item') THEN json_extract(j, '$.item') ELSE j END AS leaf FROM el WHERE json_type(j) = 'OBJECT'),
use AS (SELECT report, page, row_number() OVER (PARTITION BY report, page ORDER BY i) - 1 AS pos, leaf FROM ok
        WHERE json_type(leaf) = 'OBJECT' AND len(json_keys(leaf)) > 0),
got AS (SELECT report, page, count(*) AS n FROM use GROUP BY 1, 2),
seq AS (SELECT arr.report, arr.page, coalesce(n, 0) AS n, row_number() OVER w AS k, last_value(total IGNORE NULLS) OVER w AS known
        FROM arr LEFT JOIN got ON got.report = arr.report AND got.page = arr.page WINDOW w AS (PARTITION BY arr.report ORDER BY arr.page)),
fin AS (SELECT report, min(k) AS k FROM seq WHERE n = 0 OR k * 500 >= known GROUP BY report),
rec AS (SELECT use.report, use.page, pos, {_FIELDS} FROM use JOIN seq ON seq.report = use.report AND seq.page = use.page
        LEFT JOIN fin ON fin.report = use.report WHERE seq.k <= coalesce(fin.k, seq.k))
SELECT * FROM rec WHERE trim(coalesce(productCode, '')) <> ''"""

SQL["ad_sheet_blocks"] = with_views(["ad_sheet"]) + f""",
hd AS (SELECT row_idx AS block_row, c_date AS ad_date FROM ad_sheet WHERE {_IS_HEAD} AND c_date IS NOT NULL)
SELECT a.row_idx, a.c2, h.block_row, h.ad_date
FROM ad_sheet a ASOF LEFT JOIN hd h ON a.row_idx >= h.block_row"""
