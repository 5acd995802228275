"""DuckDB SQL of the operators that SQL can state (those of mixing and URL filter stand with them)."""

from __future__ import annotations

from .line_cleaning import BOILERPLATE, LOSS_PERCENT, SYMBOL_SHARE
from .secret_scan import RULES

WORD = r"[^\x20\x09-\x0D]+"
DOCS = f"""d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d)"""

#: The table of the CRC-32 (polynomial EDB88320, reflected), as a list in one row.
CRC = """crc_table AS (SELECT list(c ORDER BY i) AS crc_t FROM (
  SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def _crc(codes: str, first: str = "4294967295::BIGINT") -> str:
    """State of the CRC-32 after a list of byte values (its complement is the CRC)."""
    return f"list_reduce(list_concat([{first}], {codes}), lambda c, b: xor(crc_t[(xor(c, b) & 255) + 1], c >> 8))"


def _ascii(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda k: unicode(({text})[k])::BIGINT)"


def _quoted(text: str) -> str:
    return text.replace("'", "''")


def _rule(rank: int, rule) -> str:
    p = _quoted(rule.pattern.replace("(?ai)", "(?i)"))
    group = f"regexp_extract_all(t, '{p}', {rule.group})" if rule.group else "m"
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, {rule.base} AS base, {rule.least} AS least,
  regexp_extract_all(t, '{p}') AS m, {group} AS g, string_split_regex(t, '{p}') AS s FROM d WHERE regexp_matches(t, '{p}')"""


SECRETS = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({" UNION ALL ".join(_rule(i, r) for i, r in enumerate(RULES))}),
x AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM k),
y AS (SELECT doc_id, kind, rank, base, length(m[i]) AS n,
             list_sum(list_transform(s[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS st
      FROM x WHERE length(g[i]) >= least),
z AS (SELECT *, kind || ':' || st::BIGINT || ':' || (st + n)::BIGINT AS span FROM y),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY st, rank) FILTER (base) AS b,
               string_agg(span, ',' ORDER BY st, rank) AS spans FROM z GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""

LINES = f"""WITH {DOCS},
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
l0 AS (SELECT doc_id, ls[i] AS line, i FROM (SELECT doc_id, string_split(t, chr(10)) AS ls, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d)),
l1 AS (SELECT *, regexp_extract_all(line, '{WORD}') AS lw, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup FROM l0
       WHERE regexp_matches(line, '{WORD}')),
l2 AS (SELECT *, length(array_to_string(lw, '')) AS chars, len(regexp_extract_all(line, '[!#*$%&|<>{{}}~^]')) AS marks,
              len(regexp_extract_all(line, '[|]')) AS bars, right(lw[len(lw)], 1) AS last FROM l1),
l3 AS (SELECT *, {SYMBOL_SHARE} * marks > chars OR (bars >= 3 AND len(lw) <= 3 * bars)
              OR (len(lw) < 3 AND NOT (ord(last) >= 128 OR last IN ('.', '!', '?', ':', ';', ',', '"', '''', ')')))
              OR (len(lw) <= 30 AND regexp_matches(line, '(?i){"|".join(BOILERPLATE)}')) AS fails FROM l2),
per AS (SELECT doc_id, count(*) FILTER (dup) AS n_dup, count(*) FILTER (fails) AS n_fail, coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS gone
        FROM l3 GROUP BY doc_id),
a AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_fail, 0) AS n_lines_removed, coalesce(gone, 0) AS chars_removed
      FROM w LEFT JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND 100 * chars_removed <= {LOSS_PERCENT} * word_chars AS kept FROM b"""

SUBSTRINGS = f"""WITH {DOCS},
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, ws[p] AS word, p FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

JACCARD = f"""WITH RECURSIVE {DOCS},
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM
      (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE pair.c * 9 >= 4 * (a.c + b.c)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT d.doc_id, least(d.doc_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = d.doc_id), d.doc_id)) AS class_id,
       (SELECT count(*) FROM link WHERE link.x = d.doc_id) AS n_links FROM d"""

VECTORS = """WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
c AS (SELECT vec_id, least(vec_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = vec_id), vec_id)) AS component_id,
             (SELECT count(*) FROM link WHERE link.x = vec_id) AS n_links FROM embeddings)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM c"""

RUNS = f"""WITH {DOCS},
{CRC},
h AS (SELECT doc_id, ws, len(ws) AS n, xor({_crc(_ascii("coalesce(doc_id::VARCHAR, '')"))}, 4294967295) AS h FROM w, crc_table),
p AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM h),
v AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END) ELSE ws END AS ws FROM p),
words AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(n)) AS i FROM v),
equal AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
          ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
island AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM equal),
stretch AS (SELECT doc_id, q, min(i) AS s, min(i) + count(*) + q AS e FROM island GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(12, 2 * q)),
run AS (SELECT doc_id, s, e - s AS len, min(q) AS q FROM stretch GROUP BY doc_id, s, e),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY len DESC, s, q) AS k FROM run),
per AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period, (1000 * len) // q AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.k, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN best ON best.doc_id = d.doc_id AND best.k = 1"""

#: UTF-8 of a run: code points past U+007F are U+00C0 to U+00FF, two bytes with C3 first.
RUN_BYTES = """flatten(list_transform(range(1, length(run) + 1),
  lambda k: CASE WHEN unicode(run[k]) < 128 THEN [unicode(run[k])::BIGINT] ELSE [195, unicode(run[k])::BIGINT - 64] END))"""

VARIANTS = f"""WITH RECURSIVE {CRC},
docs AS (SELECT doc_id, text, {_crc(_ascii("coalesce(doc_id::VARCHAR, '') || ':'"))} AS state FROM documents, crc_table),
runs AS (SELECT doc_id, any_value(state) AS state, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
         FROM (SELECT doc_id, state, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM docs) GROUP BY 1, 3),
hashed AS (SELECT run, c, xor({_crc(RUN_BYTES, "state")}, 4294967295) AS h FROM runs, crc_table WHERE length(run) >= 6),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
          FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(c) >= 5),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS masked, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.masked = b.masked AND a.word <> b.word
         UNION SELECT cut.word, words.word FROM cut JOIN words ON less = words.word
         UNION SELECT words.word, cut.word FROM cut JOIN words ON less = words.word),
best AS (SELECT near.word, any_value(w.n) AS n, count(*) AS n_near, arg_min(other, (-o.n, other)) AS top, max(o.n) AS top_n
         FROM near JOIN words w ON w.word = near.word JOIN words o ON o.word = other GROUP BY near.word),
form AS (SELECT word, top, top_n FROM best WHERE top_n >= 5 * n),
chain(word, here, k) AS (SELECT word, word, 0 FROM words UNION ALL SELECT c.word, f.top, k + 1 FROM chain c JOIN form f ON f.word = c.here)
SELECT words.word, form.top AS form, (SELECT arg_max(here, k) FROM chain WHERE chain.word = words.word) AS root, words.n, coalesce(n_near, 0) AS n_near, form.top_n AS form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN form USING (word)"""
