"""DuckDB SQL for the registered queries that SQL can express; fixed values are stated again here
so that a change of a constant in an operator shows."""

from __future__ import annotations

from tontine.llm.licenses import TEMPLATES  # licence texts: data, not logic

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _alnum(c: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f"coalesce({c}, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


def _blank(c: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f"coalesce({c}, '')")}, '[^\\x20\\x09-\\x0D]+')"


_TEMPLATE_ROWS = ", ".join("({}, '{}', '{}')".format(i, s, t.replace("'", "''")) for i, (s, t) in enumerate(TEMPLATES))
_MENTIONS = ("(?i)licen[cs]e|copyright|copyleft|spdx|permission is hereby granted|permission to use|redistribution and use|redistributions of source"
             "|free software|public domain|creative commons|all rights reserved")
_MARKS = r"\A[ \t\r\f/*#;%<!>-]+|[ \t\r\f/*>-]+\z"

OP1 = f"""
WITH files AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || coalesce(CAST(doc_id // 1000 AS VARCHAR), 'none')
         || '/' || coalesce(CAST(doc_id AS VARCHAR), 'none') || '.txt' AS path,
         row_number() OVER () AS rid
  FROM documents),
tpl(template, license, body) AS (VALUES {_TEMPLATE_ROWS}),
para AS (
  SELECT rid, list_filter(regexp_split_to_array(array_to_string([regexp_replace(x, '{_MARKS}', '', 'g') FOR x IN string_split(text, chr(10))], chr(10)), '\\n\\n+'),
                          lambda p: regexp_matches(replace(p, chr(10), ' '), '{_MENTIONS}')) AS ps
  FROM files WHERE regexp_matches(text, '{_MENTIONS}')),
occ AS (
  SELECT rid, unnest(list_distinct(list_concat(
    list_filter(flatten([string_split(p, chr(10)) FOR p IN ps]), lambda x: regexp_matches(x, '{_MENTIONS}')),
    list_filter(flatten([regexp_split_to_array(replace(p, chr(10), ' '), '[.;!?]+ +') FOR p IN ps]), lambda x: regexp_matches(x, '{_MENTIONS}')),
    [replace(p, chr(10), ' ') FOR p IN ps]))) AS line FROM para),
units AS (SELECT DISTINCT line FROM occ),
ut AS (SELECT line, term, count(*) AS tf FROM (SELECT line, unnest(regexp_split_to_array(lower(line), '[^a-z0-9]+')) AS term FROM units) WHERE term <> '' GROUP BY ALL),
tt AS (SELECT template, license, term, count(*) AS tf
       FROM (SELECT template, license, unnest(regexp_split_to_array(lower(body), '[^a-z0-9]+')) AS term FROM tpl) WHERE term <> '' GROUP BY ALL),
n AS (SELECT count(*) AS n FROM tpl),
idf AS (SELECT term, ln((1 + (SELECT n FROM n)) / (1.0::DOUBLE + count(*))) + 1 AS idf FROM tt GROUP BY term),
uw AS (SELECT line, term, (1 + ln(tf)) * coalesce(idf, ln(1.0::DOUBLE + (SELECT n FROM n)) + 1) AS w FROM ut LEFT JOIN idf USING (term)),
tw AS (SELECT template, license, term, (1 + ln(tf)) * idf AS w FROM tt JOIN idf USING (term)),
un AS (SELECT line, sqrt(sum(w * w)) AS norm, count(*) AS terms FROM uw GROUP BY line),
tn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM tw GROUP BY template),
cosine AS (SELECT uw.line, tw.template, tw.license, any_value(un.terms) AS terms, round(sum(uw.w * tw.w) / (any_value(un.norm) * any_value(tn.norm)), 6) AS score
           FROM uw JOIN tw USING (term) JOIN un ON un.line = uw.line JOIN tn ON tn.template = tw.template GROUP BY uw.line, tw.template, tw.license),
best AS (SELECT line, license, score, round(score * sqrt(terms), 6) AS mass FROM cosine QUALIFY row_number() OVER (PARTITION BY line ORDER BY score DESC, template) = 1),
own AS (SELECT rid, license, score, covered FROM (
          SELECT rid, license, score, max(length(line)) OVER (PARTITION BY rid) AS covered,
                 row_number() OVER (PARTITION BY rid ORDER BY mass DESC, score DESC, md5(line) DESC) AS k
          FROM occ JOIN best USING (line) WHERE score >= 0.5) WHERE k = 1),
got AS (SELECT f.doc_id, f.path, regexp_extract(f.path, '^(.*)/[^/]*$', 1) AS dir, o.license AS own_license, o.score AS own_score,
               o.license IS NOT NULL AND o.covered >= 0.5 * length(f.text) AS speaks
        FROM files f LEFT JOIN own o USING (rid)),
speak AS (SELECT dir, own_license AS license FROM (SELECT dir, own_license, count(*) AS c FROM got WHERE speaks GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY dir ORDER BY c DESC, own_license DESC) = 1),
dirs AS (SELECT DISTINCT dir FROM got),
near AS (SELECT d.dir, s.license, s.dir AS from_dir FROM dirs d JOIN speak s ON s.dir = '' OR d.dir = s.dir OR starts_with(d.dir, s.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(s.dir) DESC) = 1)
SELECT doc_id, path, own_license, own_score, coalesce(own_license, near.license) AS license,
       CASE WHEN own_license IS NULL THEN near.from_dir END AS inherited_from
FROM got LEFT JOIN near USING (dir)
"""

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_alnum("text")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_alnum("text")} AS w FROM benchmark),
bk AS (SELECT item, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS words
       FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
dw AS (SELECT rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS words
       FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bk) WHERE len(w) >= k)),
hit AS (SELECT rid, dw.k, i, item FROM dw JOIN bw ON bw.words = dw.words AND bw.k = dw.k),
pos AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN ids USING (rid)
"""

OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_blank("text")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL)
         JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

OP4 = f"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
           FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
k AS (SELECT doc_id, i, line, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
hot AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, hot.key IS NOT NULL AND doc_id <> keep AS gone FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP5 = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_blank("text")}) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][k % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS lim FROM s),
c AS (SELECT *, lim / weight AS stop,
             (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS budget, (SELECT sum(weight) FROM w) AS all_weight,
             coalesce(sum(lim) OVER before, 0) AS lims, coalesce(sum(weight) OVER before, 0) AS weights
      FROM w WINDOW before AS (ORDER BY lim / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lam AS (SELECT (budget - lims) / (all_weight - weights) AS level FROM c WHERE (budget - lims) / (all_weight - weights) <= stop ORDER BY stop, k LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(lim, weight * (SELECT level FROM lam)), lim) AS target FROM c),
cum AS (SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, e, CASE WHEN target > 0 THEN CAST(upto + e * source_size AS DOUBLE) / target ELSE 'inf'::DOUBLE END AS finish FROM cum, (VALUES (0), (1)) AS x(e)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, h, doc_id, size, e ROWS UNBOUNDED PRECEDING) AS total FROM q)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN total <= (SELECT sum(target) FROM t) + 1e-6 THEN size ELSE 0 END) AS BIGINT) AS taken
FROM r GROUP BY doc_id, size, source_size, target
"""

_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
OP10 = f"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, url, {_LOWER.format(f"coalesce(regexp_extract(url, '{_URL}', 1), '')")} AS host,
                  coalesce(regexp_extract(url, '{_URL}', 2), '') AS path,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '') AS query FROM pages),
rules(rule, verdict, rhost, rpath) AS (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
  ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
fit AS (SELECT rid, rule, verdict FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC) = 1),
tok AS (SELECT rid, list_sort(list_distinct(list_concat(
          [('h:' || x) FOR x IN string_split(host, '.') IF x <> ''],
          [('p:' || x) FOR x IN string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/') IF x <> ''],
          [('q:' || x) FOR x IN [regexp_extract(y, '^([^=]*)', 1) FOR y IN string_split(query, '&')] IF x <> '']))) AS t FROM u),
lab AS (SELECT rid, t, verdict FROM tok JOIN fit USING (rid) WHERE len(t) > 0),
combo AS (SELECT rid, [t[i] FOR i IN range(1, len(t) + 1) IF (b >> (i - 1)) & 1 = 1] AS a FROM (SELECT rid, t, unnest(range(1, 1 << len(t))) AS b FROM tok)),
n AS (SELECT count(*) AS n FROM lab),
freq AS (SELECT a, count(*) AS c FROM combo JOIN lab USING (rid) GROUP BY a),
mined AS (SELECT a, verdict, count(*) AS c FROM combo JOIN lab USING (rid) GROUP BY a, verdict),
rule2 AS (SELECT mined.a, mined.verdict, mined.c / freq.c AS confidence, mined.c AS support FROM mined JOIN freq USING (a)
          WHERE mined.c >= ceil(0.005 * (SELECT n FROM n)) AND mined.c / freq.c >= 0.9),
best AS (SELECT rid, verdict FROM combo JOIN rule2 USING (a)
         QUALIFY row_number() OVER (PARTITION BY rid ORDER BY confidence DESC, support DESC, verdict = 'allow' DESC) = 1)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, best.verdict, 'allow') AS verdict
FROM u LEFT JOIN fit USING (rid) LEFT JOIN best USING (rid)
"""

_ROLL = " + ".join(f"lead(h, {j}, 0) OVER o * {pow(1103515245, 4 - j, 1 << 31)}::HUGEINT" for j in range(5))
OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, count(*) OVER () AS n FROM documents),
e AS (SELECT d.doc_id, d.r, x.r AS nr, d.text, CAST(length(d.text) AS BIGINT) AS nc, substr(d.text, 1, length(d.text) - length(d.text) // 2) || substr(x.text, 1, length(d.text) // 2) AS edited
      FROM d JOIN d x ON x.r = d.r % d.n + 1),
t AS (SELECT r, 0 AS kind, text FROM e UNION ALL SELECT r, 1, edited FROM e),
w AS (SELECT r, kind, i, ws[i] AS word, len(ws) AS m
      FROM (SELECT r, kind, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT r, kind, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM t))),
h AS (SELECT *, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) & 2147483647 AS h FROM w),
g AS (SELECT r, kind, i, m, ({_ROLL}) % 2147483648 AS g, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram
      FROM h WINDOW o AS (PARTITION BY r, kind ORDER BY i)),
v AS (SELECT r, kind, i, m, min(g * 4294967296 + (4294967295 - i)) OVER (PARTITION BY r, kind ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS low FROM g WHERE i <= m - 4),
c AS (SELECT DISTINCT r, kind, CAST(4294967295 - low % 4294967296 AS BIGINT) AS i FROM v WHERE i <= greatest(1, m - 11)
      UNION ALL SELECT r, kind, i FROM w WHERE m < 5 AND i = 1),
k AS (SELECT r, kind, i - 1 AS pos, substr(md5(gram), 1, 16) AS hash FROM c JOIN g USING (r, kind, i)),
f AS (SELECT r, kind, string_agg(pos || ':' || hash, ',' ORDER BY pos) AS f, count(DISTINCT hash) AS n FROM k GROUP BY r, kind),
u AS (SELECT DISTINCT r, kind, hash FROM k),
pe AS (SELECT a.r, count(*) AS c FROM u a JOIN u b ON b.r = a.r AND b.hash = a.hash WHERE a.kind = 0 AND b.kind = 1 GROUP BY a.r),
pn AS (SELECT e.r, count(*) AS c FROM e JOIN u a ON a.r = e.r AND a.kind = 0 JOIN u b ON b.r = e.nr AND b.kind = 0 AND b.hash = a.hash GROUP BY e.r)
SELECT e.doc_id, e.nc AS n_chars, sha256(e.edited) AS edited_sha256, coalesce(a.f, '') AS fingerprint, coalesce(b.f, '') AS edited_fingerprint,
       CASE WHEN coalesce(a.n, 0) + coalesce(b.n, 0) = 0 THEN 1.0::DOUBLE ELSE coalesce(pe.c, 0) / (coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(pe.c, 0))::DOUBLE END AS near_edited,
       CASE WHEN coalesce(a.n, 0) + coalesce(x.n, 0) = 0 THEN 1.0::DOUBLE ELSE coalesce(pn.c, 0) / (coalesce(a.n, 0) + coalesce(x.n, 0) - coalesce(pn.c, 0))::DOUBLE END AS near_next
FROM e LEFT JOIN f a ON a.r = e.r AND a.kind = 0 LEFT JOIN f b ON b.r = e.r AND b.kind = 1 LEFT JOIN f x ON x.r = e.nr AND x.kind = 0
LEFT JOIN pe ON pe.r = e.r LEFT JOIN pn ON pn.r = e.r
"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_alnum("text")} AS t FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_alnum("text")}) AS t FROM benchmark),
stat AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM p, stat GROUP BY term),
s AS (SELECT q, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM (SELECT q, unnest(t) AS term FROM b) JOIN p USING (term) JOIN w USING (term), stat GROUP BY q, r),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k JOIN b USING (q) WHERE rank <= 10
"""

OP13 = f"""
WITH RECURSIVE tab(n, k, v) AS (SELECT range, 0, range FROM range(256) UNION ALL
  SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8),
crc(c, s, i, v) AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, 4294967295 FROM conversations WHERE conv_id IS NOT NULL UNION ALL
  SELECT c, s, i + 1, xor(crc.v >> 8, tab.v) FROM crc JOIN tab ON tab.k = 8 AND tab.n = xor(crc.v, ascii(s[i + 1])) & 255 WHERE i < length(s)),
h AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE i = length(s)),
o AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
reb AS (SELECT o.c, list_concat(CASE WHEN h > 0 AND b.c IS NOT NULL THEN b.ts[1:h] ELSE [] END, o.ts[h + 1:]) AS ts
        FROM o JOIN h USING (c) LEFT JOIN o b ON b.c = o.c - o.c % 20),
occ AS (SELECT c, d, ts[1:d] AS p, d = len(ts) AS last FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM reb)),
n AS (SELECT p, d, min(c) AS c, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends FROM occ GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
e AS (SELECT n.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len({_blank("n.p[n.d].t")}) END AS saved FROM n LEFT JOIN kids USING (p)),
up AS (SELECT p[1:k] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM (SELECT p, saved, n_children, unnest(range(0, d + 1)) AS k FROM e) GROUP BY 1)
SELECT e.c AS conv_id, e.d AS depth, CASE WHEN e.d > 0 THEN f.c END AS parent_conv_id, e.n_convs, e.n_children, up.n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, e.ends AS ends_sha256
FROM e JOIN up ON up.p = e.p LEFT JOIN n f ON e.d > 0 AND f.p = e.p[1:e.d - 1]
"""

SQL = {"op1_license_scan": OP1, "op2_decontaminate": OP2, "op3_near_dup": OP3, "op4_line_dedup": OP4, "op5_mixing": OP5, "op10_url_filter": OP10, "op11_fingerprints": OP11, "op12_lexical_search": OP12, "op13_prefix_trie": OP13}
