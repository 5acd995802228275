"""Oracle SQL: sheet compare (Q12) and ad order (Q11)."""

from stockroom import config

from . import brief
from .common import with_views


def _digits(c: str) -> str:
    return f"regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '[^0-9]', '', 'g')"


def _sq(c: str) -> str:
    return f"regexp_replace(trim(lower(coalesce(CAST({c} AS VARCHAR), ''))), '\\s+', ' ', 'g')"


def _norm(c: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(coalesce(CAST({c} AS VARCHAR), '')), '[^a-z0-9 ]', ' ', 'g'),"
            f" '\\s+', ' ', 'g'))")


SNAP = f"snap AS (SELECT * FROM ({brief.SQL['inventory_snapshot']}) s0)"

SQL = {}
SQL["sheet_compare"] = with_views(["catalog", "upload", "deals", "par_list"], SNAP) + f""",
cat AS (SELECT *, {_digits('code')} AS ck FROM catalog),
bycode AS (SELECT ck, arg_max(item, cat_row) AS c_item, arg_max(unit_cost, cat_row) AS our_cost,
                  arg_max(price, cat_row) AS our_retail FROM cat WHERE ck <> '' GROUP BY ck),
bydesc AS (SELECT {_sq('item')} AS dk, arg_max(ck, cat_row) AS code2 FROM cat
           WHERE ck <> '' AND {_sq('item')} <> '' GROUP BY {_sq('item')}),
u AS (SELECT *, {_digits('up_code')} AS their_code, {_sq('up_item')} AS dk FROM upload),
j AS (SELECT u.*, b.c_item, b.our_cost, b.our_retail, d.code2 FROM u LEFT JOIN bycode b ON b.ck = u.their_code
      LEFT JOIN bydesc d ON d.dk = u.dk),
j2 AS (SELECT *, (c_item IS NULL AND coalesce(up_item, '') <> '' AND code2 IS NOT NULL) AS fb FROM j),
j3 AS (SELECT j2.up_row, j2.up_item, j2.up_price, CASE WHEN fb THEN code2 ELSE their_code END AS upc,
              coalesce(j2.c_item, b2.c_item) AS ci, coalesce(j2.our_cost, b2.our_cost) AS oc,
              coalesce(j2.our_retail, b2.our_retail) AS orr
       FROM j2 LEFT JOIN bycode b2 ON j2.fb AND b2.ck = j2.code2),
j4 AS (SELECT j3.*, st.chain_oh AS oh, st.wos FROM j3 LEFT JOIN snap st ON j3.ci IS NOT NULL AND {_sq('j3.ci')} = {_sq('st.item')})
SELECT up_row, CASE WHEN coalesce(up_item, '') <> '' THEN up_item ELSE coalesce(ci, '') END AS their_item, upc,
       CASE WHEN ci IS NOT NULL THEN 'Yes' ELSE 'No' END AS carry, up_price AS their_price,
       CASE WHEN ci IS NOT NULL THEN oc END AS our_cost,
       CASE WHEN ci IS NOT NULL AND up_price IS NOT NULL AND coalesce(oc <> 0, false)
            THEN round_even((oc - up_price) / oc * 100, 1) + 0.0 END AS vs_cost_pct,
       CASE WHEN ci IS NOT NULL THEN orr END AS our_retail,
       CASE WHEN ci IS NOT NULL THEN oh END AS oh, CASE WHEN ci IS NOT NULL THEN wos END AS wos,
       CASE WHEN ci IS NULL THEN 'we don''t carry / not found' WHEN wos < 2 THEN 'LOW — restock'
            WHEN wos > 12 THEN 'OVERSTOCK — skip' END AS flag
FROM j4"""

SQL["sheet_compare_summary"] = f"""SELECT count(*) AS total, count(*) FILTER (WHERE carry = 'Yes') AS matched,
       count(*) FILTER (WHERE carry = 'No') AS not_carried, count(*) FILTER (WHERE vs_cost_pct > 0) AS cheaper_than_our_cost,
       count(*) FILTER (WHERE flag LIKE 'LOW%') AS low_stock, count(*) FILTER (WHERE flag LIKE 'OVERSTOCK%') AS overstock
FROM ({SQL['sheet_compare']}) c"""

_ABBR = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in config.ABBREVIATIONS.items())
_T = config.AD_TARGETS["thc"]

AD = f"""ac AS (
  SELECT c.cat_row AS cid, {_digits('c.code')} AS upc, c.item AS "desc", {_norm('c.item')} AS nd, c.case_pack AS units_case,
         c.unit_cost * c.case_pack AS net_case, c.price * c.case_pack AS retail_case,
         coalesce(b.bm_text, '') AS bm_text
  FROM catalog c LEFT JOIN (SELECT code_key, string_agg(CAST(m AS VARCHAR), '|' ORDER BY m) AS bm_text
                            FROM (SELECT DISTINCT code_key, CAST(m AS INTEGER) AS m FROM buy_months) GROUP BY code_key) b
    ON b.code_key = c.code_key),
ctok AS (SELECT DISTINCT cid, unnest(string_split(nd, ' ')) AS tok FROM ac WHERE nd <> ''),
ctok2 AS (SELECT * FROM ctok WHERE tok <> ''),
sp AS (SELECT line_id, raw, kind, regexp_split_to_array(raw, '\\s*/\\s*') AS arr FROM ad_lines),
sp2 AS (SELECT line_id, raw, kind, trim(arr[i]) AS p, i FROM (SELECT *, unnest(generate_series(1, len(arr))) AS i FROM sp)),
parts0 AS (SELECT line_id, raw, kind, p, row_number() OVER (PARTITION BY line_id ORDER BY i) - 1 AS pi FROM sp2 WHERE p <> ''),
parts AS (
  SELECT line_id, raw, kind, pi,
         regexp_matches(p, '(?i)\\ball\\b|\\(all|all types|all varietals|all flavors|all varieties') AS is_brand,
         coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p,
             '\\(all[^)]*\\)', ' ', 'gi'), '\\ball (types|varietals|flavors|varieties)\\b', ' ', 'gi'),
             '\\ball\\b', ' ', 'gi'), '\\s+', ' ', 'g')), ''), p) AS q,
         CASE lower(kind) WHEN 'sunday' THEN {_T['sunday']} WHEN 'weekly' THEN {_T['weekly']} ELSE 4.5 END AS target
  FROM parts0),
single AS (SELECT *, {_digits('q')} AS dig, {_norm('q')} AS nq FROM parts WHERE NOT is_brand),
byupc AS (SELECT upc, max(cid) AS u_cid FROM ac WHERE upc <> '' GROUP BY upc),
bydesc AS (SELECT nd, min(cid) AS e_cid FROM ac WHERE nd <> '' GROUP BY nd),
s1 AS (SELECT s.*, CASE WHEN length(dig) >= 11 THEN coalesce(u1.u_cid, u2.u_cid) END AS upc_cid, d.e_cid
       FROM single s LEFT JOIN byupc u1 ON u1.upc = s.dig LEFT JOIN byupc u2 ON u2.upc = ltrim(s.dig, '0')
       LEFT JOIN bydesc d ON d.nd = s.nq),
qraw AS (SELECT DISTINCT line_id, pi, unnest(string_split(nq, ' ')) AS t FROM s1 WHERE upc_cid IS NULL AND e_cid IS NULL),
qtok AS (SELECT DISTINCT line_id, pi, unnest(string_split(CASE t {_ABBR} ELSE t END, ' ')) AS qt FROM qraw),
qtok2 AS (SELECT * FROM qtok WHERE qt <> ''),
qn AS (SELECT line_id, pi, count(*) AS n_q FROM qtok2 GROUP BY line_id, pi),
hits AS (SELECT q.line_id, q.pi, c.cid, count(DISTINCT q.qt) AS hits FROM qtok2 q JOIN ctok2 c
         ON q.qt = c.tok OR (length(q.qt) >= 3 AND length(q.qt) < length(c.tok) AND starts_with(c.tok, q.qt))
         GROUP BY q.line_id, q.pi, c.cid),
fz AS (SELECT h.line_id, h.pi, arg_min(h.cid, (-(h.hits / n.n_q), h.cid)) AS f_cid, max(h.hits / n.n_q) AS sc
       FROM hits h JOIN qn n ON n.line_id = h.line_id AND n.pi = h.pi GROUP BY h.line_id, h.pi),
s2 AS (SELECT s1.*, CASE WHEN fz.sc >= 0.6 THEN fz.f_cid END AS f_cid FROM s1 LEFT JOIN fz ON fz.line_id = s1.line_id AND fz.pi = s1.pi),
srows AS (SELECT line_id, pi, 0 AS bi, coalesce(upc_cid, e_cid, f_cid) AS cid,
                 CASE WHEN upc_cid IS NOT NULL THEN 'upc' WHEN e_cid IS NOT NULL THEN 'exact' ELSE 'fuzzy' END AS conf,
                 target, false AS many FROM s2 WHERE coalesce(upc_cid, e_cid, f_cid) IS NOT NULL),
smiss AS (SELECT line_id, pi, q AS unmatched FROM s2 WHERE coalesce(upc_cid, e_cid, f_cid) IS NULL),
brand AS (SELECT * FROM parts WHERE is_brand),
btok AS (SELECT DISTINCT line_id, pi, unnest(string_split({_norm('q')}, ' ')) AS tok FROM brand),
btok2 AS (SELECT * FROM btok WHERE length(tok) >= 2),
bn AS (SELECT line_id, pi, count(*) AS n_q FROM btok2 GROUP BY line_id, pi),
bh AS (SELECT b.line_id, b.pi, c.cid FROM btok2 b JOIN ctok2 c ON c.tok = b.tok GROUP BY b.line_id, b.pi, c.cid
       HAVING count(*) = (SELECT n_q FROM bn WHERE bn.line_id = b.line_id AND bn.pi = b.pi)),
bh2 AS (SELECT *, row_number() OVER (PARTITION BY line_id, pi ORDER BY cid) AS bi,
               count(*) OVER (PARTITION BY line_id, pi) AS n FROM bh),
brows AS (SELECT h.line_id, h.pi, h.bi, h.cid, 'brand' AS conf, b.target, h.n > 40 AS many
          FROM bh2 h JOIN brand b ON b.line_id = h.line_id AND b.pi = h.pi),
bmiss AS (SELECT line_id, pi, raw AS unmatched FROM brand b
          WHERE NOT EXISTS (SELECT 1 FROM bh WHERE bh.line_id = b.line_id AND bh.pi = b.pi)),
r0 AS (SELECT r.*, ac.upc, ac."desc", ac.nd, ac.units_case, ac.net_case, ac.retail_case, ac.bm_text
       FROM (SELECT * FROM srows UNION ALL SELECT * FROM brows) r JOIN ac ON ac.cid = r.cid),
r1 AS (SELECT * FROM (SELECT *, CASE WHEN upc <> '' THEN row_number() OVER (PARTITION BY upc ORDER BY line_id, pi, bi) ELSE 1 END AS k FROM r0) WHERE k = 1),
stock AS (SELECT item AS sid, chain_oh, wk_velocity, units_90d, wos, {_norm('item')} AS nd FROM snap),
sname AS (SELECT nd, arg_min(sid, (-wk_velocity, sid)) AS x_sid FROM stock GROUP BY nd),
r2 AS (SELECT r1.*, sname.x_sid FROM r1 LEFT JOIN sname ON sname.nd = r1.nd),
nfz AS (SELECT DISTINCT nd FROM r2 WHERE x_sid IS NULL),
nq AS (SELECT DISTINCT nd, unnest(string_split(nd, ' ')) AS qt FROM nfz),
nq2 AS (SELECT * FROM nq WHERE qt <> ''),
nn AS (SELECT nd, count(*) AS n_q FROM nq2 GROUP BY nd),
stok AS (SELECT DISTINCT sid, unnest(string_split(nd, ' ')) AS tok FROM stock),
sh AS (SELECT q.nd, s.sid, count(DISTINCT q.qt) AS hits FROM nq2 q JOIN stok s
       ON q.qt = s.tok OR (length(q.qt) >= 3 AND length(q.qt) < length(s.tok) AND starts_with(s.tok, q.qt))
       WHERE s.tok <> '' GROUP BY q.nd, s.sid),
sfz AS (SELECT h.nd, arg_min(h.sid, (-(h.hits / n.n_q), -st.wk_velocity, h.sid)) AS f_sid
        FROM sh h JOIN nn n ON n.nd = h.nd JOIN stock st ON st.sid = h.sid GROUP BY h.nd),
r3 AS (SELECT r2.*, coalesce(x_sid, sfz.f_sid) AS sid FROM r2 LEFT JOIN sfz ON sfz.nd = r2.nd),
multi AS (SELECT nd, count(DISTINCT upc) AS n_upc FROM ac WHERE upc <> '' GROUP BY nd),
r4 AS (SELECT r3.*, st.chain_oh, st.wk_velocity, st.units_90d, st.wos AS s_wos, m.n_upc,
              r3.sid IS NOT NULL AS has_inv FROM r3 LEFT JOIN stock st ON st.sid = r3.sid LEFT JOIN multi m ON m.nd = r3.nd),
r5 AS (SELECT *, CASE WHEN has_inv THEN CAST(coalesce(chain_oh, 0) AS DOUBLE) ELSE 0.0 END AS oh,
              CASE WHEN has_inv THEN coalesce(wk_velocity, 0.0) ELSE 0.0 END AS v30,
              CASE WHEN has_inv THEN coalesce(units_90d, 0) * 7.0 / 90.0 ELSE 0.0 END AS v90 FROM r4),
r6 AS (SELECT *, CASE WHEN v30 > 0 THEN v30 ELSE v90 END AS vel,
              CASE WHEN units_case <> 0 THEN units_case ELSE 1.0 END AS cpk,
              CASE WHEN coalesce(net_case, 0.0) <> 0 THEN net_case ELSE coalesce(retail_case, 0.0) END AS price FROM r5),
r7 AS (SELECT *, greatest(target * vel - oh, 0.0) AS need_u,
              list_sort(list_distinct(list_filter(list_transform(string_split(lower(bm_text), '|'),
                   lambda x: CASE WHEN x SIMILAR TO '[0-9]{{1,2}}' AND CAST(x AS INTEGER) BETWEEN 1 AND 12 THEN CAST(x AS INTEGER) END),
                   lambda x: x IS NOT NULL))) AS months
       FROM r6),
r8 AS (SELECT *, CASE WHEN vel > 0 THEN CAST(CASE WHEN need_u > 0 THEN ceil(need_u / cpk) ELSE 0 END AS BIGINT) END AS cases FROM r7)"""

_HEAD = with_views(["catalog", "buy_months", "ad_lines", "deals", "par_list"], SNAP, AD)

SQL["ad_order"] = _HEAD + """
SELECT line_id, pi, bi, upc, trim(regexp_replace("desc", '\\s+', ' ', 'g')) AS item,
       CAST(round_even(oh, 0) AS BIGINT) AS on_hand, round_even(vel, 1) + 0.0 AS wk_vel,
       round_even(CASE WHEN vel > 0 THEN oh / vel WHEN has_inv THEN coalesce(s_wos, 0.0) ELSE 0.0 END, 1) + 0.0 AS wos,
       target AS target_wos, cases AS suggested_cases, round_even(price, 2) + 0.0 AS case_price,
       round_even(coalesce(cases, 0) * price, 2) + 0.0 AS order_usd,
       concat_ws('; ',
         CASE WHEN conf = 'brand' THEN 'whole brand' END,
         CASE WHEN conf = 'brand' AND many THEN 'many, review' END,
         CASE WHEN conf = 'fuzzy' THEN 'check match' END,
         CASE WHEN conf <> 'upc' AND coalesce(n_upc, 0) > 1 THEN 'multiple UPCs, confirm' END,
         CASE WHEN NOT has_inv THEN 'no stock data' END,
         CASE WHEN vel > 0 AND v30 <= 0 AND v90 > 0 THEN 'based on 90-day pace' END,
         CASE WHEN vel <= 0 THEN 'no recent sales, set by hand' END,
         CASE WHEN bm_text <> '' AND len(months) > 0 AND NOT list_contains(months, 6)
              THEN 'not buy month (' || bm_text || ')' END) AS flag
FROM r8"""

SQL["ad_order_unmatched"] = _HEAD + """
SELECT * FROM smiss UNION ALL SELECT * FROM bmiss"""
