"""Oracle SQL: folders of workbooks, and the ad week of every sale day."""

from .common import norm_code, with_views
from .uploads import _HITS

SQL = {}

_DEPT = "split(split(file, '/')[-1], ' ')[1]"
_NAMES = {"upc": "'product upc'", "units": "'units/case', 'units / case'", "deal": "'deal description'",
          "netunit": "'net/unit', 'net unit cost', 'net / unit'", "casecost": "'net case cost', 'invoice cost'",
          "buymonths": "'buy months (if appl.)', 'buy months'"}
_PLACES = ", ".join(f"min(j) FILTER (WHERE lower(trim(v)) IN ({n})) AS {f}_at" for f, n in _NAMES.items())
_CELLS = "cell AS (SELECT file, sheet, sheet_no, row_idx, unnest(cells) AS v, generate_subscripts(cells, 1) - 1 AS j FROM workbooks)"
_CHOSEN = _CELLS + f""",
wide AS (SELECT file, sheet, CAST(max(len(cells)) AS INT) AS width FROM workbooks GROUP BY 1, 2),
hd AS (SELECT file, sheet, any_value(sheet_no) AS sheet_no, min(row_idx) AS header_row FROM cell
       WHERE row_idx < 4 AND contains(v, 'Product UPC') GROUP BY 1, 2),
one AS (SELECT hd.*, width FROM hd JOIN wide USING (file, sheet) WHERE width >= 12
        QUALIFY row_number() OVER (PARTITION BY file ORDER BY CASE WHEN contains(lower(sheet), lower({_DEPT})) THEN 0 ELSE 1 END, sheet_no) = 1),
chosen AS (SELECT one.file, one.sheet, one.header_row, width, {_PLACES} FROM one JOIN cell ON cell.file = one.file AND cell.sheet = one.sheet
           AND cell.row_idx = one.header_row GROUP BY 1, 2, 3, 4),
usable AS (SELECT * FROM chosen WHERE upc_at IS NOT NULL AND (netunit_at IS NOT NULL OR casecost_at IS NOT NULL))"""
SQL["book_headers"] = with_views(["workbooks"], _CHOSEN) + """
SELECT file, sheet, header_row, width, CAST(upc_at AS INT) AS upc_at, CAST(units_at AS INT) AS units_at, CAST(deal_at AS INT) AS deal_at,
       CAST(netunit_at AS INT) AS netunit_at, CAST(casecost_at AS INT) AS casecost_at, CAST(buymonths_at AS INT) AS buymonths_at FROM usable"""

_CELL = lambda f: f"cells[{f}_at + 1]"
_NUM = lambda f: f"TRY_CAST(trim({_CELL(f)}) AS DOUBLE)"
_MONTHS = _HITS
_FIRST = lambda c: f"arg_min({c}, (file, row_idx)) FILTER (WHERE {c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '') AS {c}"
SQL["price_reference"] = with_views(["workbooks"], _CHOSEN) + f""",
raw AS (SELECT w.file, w.row_idx, {norm_code(_CELL('upc'))} AS code_key, {_DEPT.replace('file', 'w.file')} AS department,
               round_even(coalesce({_NUM('netunit')}, CASE WHEN {_NUM('units')} <> 0 THEN {_NUM('casecost')} / {_NUM('units')} END), 2) AS buyer_cost,
               trim(coalesce({_CELL('deal')}, '')) AS d, lower(trim(coalesce({_CELL('buymonths')}, ''))) AS s
        FROM workbooks w JOIN usable u ON u.file = w.file AND u.sheet = w.sheet AND w.row_idx > u.header_row),
rec AS (SELECT file, row_idx, code_key, department, buyer_cost, CASE WHEN lower(d) NOT IN ('nan', '') THEN d END AS deal,
               CASE WHEN s <> 'nan' THEN concat_ws('|', {_MONTHS}) END AS buy_months FROM raw)
SELECT code_key, {_FIRST('department')}, {_FIRST('buyer_cost')}, {_FIRST('deal')}, {_FIRST('buy_months')}
FROM rec WHERE code_key <> '' AND (buyer_cost IS NOT NULL OR deal IS NOT NULL OR coalesce(buy_months, '') <> '') GROUP BY code_key"""

SQL["book_inventory"] = with_views(["workbooks"], _CELLS) + """,
top AS (SELECT file, sheet, any_value(sheet_no) AS sheet_no, bool_or(v = 'OH') AND bool_or(v = 'Product Description') AS fits,
               count(DISTINCT v) FILTER (WHERE v IN ('TOH', 'PM', '30D', '90D')) + CASE WHEN bool_or(v = 'Location Name') THEN 2 ELSE 0 END AS score,
               min(j) FILTER (WHERE v = 'Product Description') AS item_at, min(j) FILTER (WHERE v = 'Location Name') AS store_at,
               min(j) FILTER (WHERE v = 'OH') AS oh_at, min(j) FILTER (WHERE v = '30D') AS u30_at, min(j) FILTER (WHERE v = '90D') AS u90_at
        FROM cell WHERE row_idx = 0 GROUP BY 1, 2),
best AS (SELECT * FROM top WHERE fits QUALIFY row_number() OVER (PARTITION BY file ORDER BY score DESC, sheet_no) = 1)
SELECT w.file, w.sheet, w.row_idx, trim(cells[item_at + 1]) AS item, cells[store_at + 1] AS store,
       coalesce(TRY_CAST(trim(cells[oh_at + 1]) AS DOUBLE), 0) AS on_hand, coalesce(TRY_CAST(trim(cells[u30_at + 1]) AS DOUBLE), 0) AS u30,
       coalesce(TRY_CAST(trim(cells[u90_at + 1]) AS DOUBLE), 0) AS u90
FROM workbooks w JOIN best b ON b.file = w.file AND b.sheet = w.sheet WHERE w.row_idx > 0 AND trim(coalesce(cells[item_at + 1], '')) <> ''"""

SQL["book_tab_items"] = with_views(["workbooks"], _CELLS) + f""",
lab AS (SELECT file, arg_min(j, (row_idx, j)) FILTER (WHERE contains(v, 'Product UPC')) AS code_at, min(row_idx) FILTER (WHERE contains(v, 'Product UPC')) AS code_row,
               arg_min(j, (row_idx, j)) FILTER (WHERE contains(v, 'Product Description')) AS item_at,
               min(row_idx) FILTER (WHERE contains(v, 'Product Description')) AS item_row
        FROM cell WHERE sheet = 'Remove' AND row_idx < 6 GROUP BY file),
it AS (SELECT w.file, w.row_idx, {norm_code('cells[code_at + 1]')} AS code, trim(coalesce(cells[item_at + 1], '')) AS item
       FROM workbooks w JOIN lab ON lab.file = w.file WHERE w.sheet = 'Remove' AND code_at IS NOT NULL AND item_at IS NOT NULL
         AND w.row_idx > greatest(code_row, item_row))
SELECT code, item, {_DEPT} AS department FROM it WHERE code <> '' AND lower(item) NOT IN ('', 'nan')
QUALIFY row_number() OVER (PARTITION BY code ORDER BY file, row_idx) = 1"""

_EXACT = ["net buy $", "net buy", "order $", "extended cost", "ext cost", "ext price", "extended price", "total $", "total cost",
          "line total", "order total", "ext $", "net $"]
SQL["book_columns"] = with_views(["workbooks"], _CELLS) + f""",
hd AS (SELECT file, sheet, min(row_idx) AS header_row FROM cell WHERE row_idx < 4 AND contains(v, 'Product UPC') GROUP BY 1, 2),
names AS (SELECT hd.file, hd.sheet, hd.header_row, j AS pl, lower(trim(v)) AS name FROM hd JOIN cell USING (file, sheet) WHERE cell.row_idx = hd.header_row),
x AS (SELECT n.*, coalesce(w.cells[pl + 1], '') AS x FROM names n JOIN workbooks w ON w.file = n.file AND w.sheet = n.sheet AND w.row_idx > n.header_row
      WHERE array_to_string(w.cells, '') <> ''),
p AS (SELECT file, sheet, pl, name, count(*) AS n, count(v) AS num, count(*) FILTER (WHERE v > 0) AS pos, count(*) FILTER (WHERE abs(v % 1) > 1e-9) AS cents,
             sum(v) AS total, count(*) FILTER (WHERE length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 11 AND 14) AS codes
      FROM (SELECT *, TRY_CAST(regexp_replace(x, '[$,]', '', 'g') AS DOUBLE) AS v FROM x) y GROUP BY 1, 2, 3, 4),
s AS (SELECT DISTINCT file, sheet FROM p),
c AS (SELECT file, sheet, pl AS code_at FROM p WHERE codes >= greatest(3, floor(n / 3)) QUALIFY row_number() OVER (PARTITION BY file, sheet ORDER BY codes DESC, pl) = 1),
e AS (SELECT file, sheet, pl AS exact_at FROM p WHERE name IN ({', '.join(f"'{n}'" for n in _EXACT)})
      QUALIFY row_number() OVER (PARTITION BY file, sheet ORDER BY list_position([{', '.join(f"'{n}'" for n in _EXACT)}], name), pl) = 1),
g AS (SELECT file, sheet, pl AS guess_at FROM p WHERE num / n >= 0.6 AND num > 0 AND pos / num >= 0.8
      QUALIFY row_number() OVER (PARTITION BY file, sheet ORDER BY regexp_matches(name, '\\$|cost|amount|extend|\\bext\\b|price|total|value|net buy') DESC,
                                 cents / num >= 0.3 DESC, total DESC, pl) = 1)
SELECT file, sheet, CAST(code_at AS INT) AS code_at, CAST(coalesce(exact_at, guess_at) AS INT) AS money_at, exact_at IS NULL AS guessed
FROM s LEFT JOIN c USING (file, sheet) LEFT JOIN e USING (file, sheet) LEFT JOIN g USING (file, sheet)"""

_HEAD = "(instr(lower(concat_ws(' ', c0, c1, c2)), 'in-store ad') > 0 OR instr(lower(concat_ws(' ', c0, c1, c2)), 'content due') > 0)"
_ASOF = f"""hd AS (SELECT sheet, c_date AS ad_date, min(row_idx) AS block_row FROM ad_sheets WHERE {_HEAD} AND c_date IS NOT NULL GROUP BY 1, 2),
fst AS (SELECT sheet, min(ad_date) AS f_date, arg_min(block_row, ad_date) AS f_row FROM hd GROUP BY 1),
dy AS (SELECT category AS sheet, day, sum(units) AS units, sum(lines) AS lines FROM history GROUP BY 1, 2),
force AS (SELECT dy.sheet, dy.day, units, lines, coalesce(hd.ad_date, f_date) AS ad_date, coalesce(hd.block_row, f_row) AS block_row
          FROM dy ASOF LEFT JOIN hd ON dy.sheet = hd.sheet AND dy.day >= hd.ad_date LEFT JOIN fst ON fst.sheet = dy.sheet)"""
SQL["ad_days"] = with_views(["ad_sheets", "history"], _ASOF) + """
SELECT sheet, day, block_row, ad_date FROM force"""
SQL["ad_week_sales"] = with_views(["ad_sheets", "history"], _ASOF) + """
SELECT sheet, ad_date, block_row, min(day) AS first_day, max(day) AS last_day, count(*) AS days, CAST(sum(units) AS DOUBLE) AS units,
       CAST(sum(lines) AS BIGINT) AS lines FROM force GROUP BY 1, 2, 3"""
