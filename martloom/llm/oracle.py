"""SQL of the operators that DuckDB can express, over the same tables."""

from __future__ import annotations

from martloom.llm.decontaminate import SHARE, WINDOW
from martloom.llm.embeddings import COSINE
from martloom.llm.jaccard import PERCENT, WORDS
from martloom.llm.urls import DAMPING, LINK, ROUNDS, THRESHOLD

_GAP = "[\\x20\\x09-\\x0D]+"
#: crc32 of the decimal text of ``c``, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
    lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END)), CAST(4294967295 AS UBIGINT))"""

OP11 = f"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{_GAP}'), lambda w: w <> '') AS words
  FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
     regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > least, false)] AS fails
  FROM d JOIN least USING (t) LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
orders AS (
  SELECT [a, b, c, d, e] AS o FROM unnest([1, 2, 3, 4, 5]) t1(a), unnest([1, 2, 3, 4, 5]) t2(b), unnest([1, 2, 3, 4, 5]) t3(c), unnest([1, 2, 3, 4, 5]) t4(d), unnest([1, 2, 3, 4, 5]) t5(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
steps AS (SELECT o, step, o[step] AS own, o[1:step - 1] AS before, list_reduce(list_transform(o, lambda i: 'ABCDE'[i]), lambda x, y: x || y) AS filter_order
  FROM orders, unnest([1, 2, 3, 4, 5]) s(step)),
judged AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fails_own, len(list_filter(before, lambda i: fails[i])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS failed
  FROM cells, steps),
rows AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant, coalesce(sum(n) FILTER (fails_own AND failed = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails_own), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails_own), 0) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM rows"""

OP12 = f"""WITH convs AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST, role, text) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, conv_id - conv_id % 20 AS base, CAST({_CRC32.format(c='conv_id')} % 4 AS INTEGER) AS h FROM convs),
rebuilt AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h], h.own[h + 1:]) AS turns FROM h LEFT JOIN convs b ON b.conv_id = h.base),
prefixes AS (SELECT conv_id, d, turns[1:d] AS prefix, len(turns) = d AS ends FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(list_filter(regexp_split_to_array(prefix[d][2], '{_GAP}'), lambda w: w <> '')) END AS words
  FROM prefixes GROUP BY prefix, d),
children AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
subtree AS (
  SELECT prefix[1:above] AS prefix, sum((n_convs - 1) * words) AS saved, sum(CAST(c.n IS NULL AS INTEGER)) AS leaves
  FROM (SELECT nodes.*, unnest(range(d + 1)) AS above FROM nodes) x LEFT JOIN children c USING (prefix) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtree s ON s.prefix = n.prefix LEFT JOIN children c ON c.prefix = n.prefix LEFT JOIN nodes p ON n.d > 0 AND p.prefix = n.prefix[1:n.d - 1]"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What follows the first :// of a url; null where there is none.
_REST = "CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) END"
_HOST = f"translate(coalesce(regexp_extract({_REST}, '^[^/?#]*'), ''), '{_UPPER}', '{_LOWER}')"
_LINK = LINK.replace("'", "''")

OP13 = f"""WITH RECURSIVE p AS (
  SELECT row_number() OVER () AS row, page_id, html, {_HOST.format(u='url')} AS host, coalesce(regexp_extract({_REST.format(u='url')}, '^[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
ruled AS (
  SELECT p.row, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.row),
judged AS (SELECT p.page_id, p.host, p.path, r.rule, r.verdict FROM p LEFT JOIN ruled r USING (row)),
links AS (SELECT host AS source, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS link FROM p),
edges AS (SELECT source, {_HOST.format(u='link')} AS target, count(*) AS weight FROM links WHERE link <> '' GROUP BY ALL HAVING source <> '' AND target <> '' AND source <> target),
flows AS (
  SELECT 'trust' AS kind, source AS a, target AS b, weight / sum(weight) OVER (PARTITION BY source) AS share FROM edges
  UNION ALL SELECT 'distrust', target, source, weight / sum(weight) OVER (PARTITION BY target) FROM edges),
waves AS (
  SELECT 0 AS i, kind, host, avg(CASE WHEN verdict = verdicts THEN 1.0 ELSE 0.0 END) AS value
  FROM judged, (VALUES ('trust', 'allow'), ('distrust', 'block')) k(kind, verdicts) GROUP BY kind, host
  UNION ALL SELECT i + 1, w.kind, f.b, sum({DAMPING} * f.share * w.value) FROM waves w JOIN flows f ON f.kind = w.kind AND f.a = w.host WHERE i < {ROUNDS} GROUP BY i, w.kind, f.b),
standing AS (SELECT host, sum(CASE WHEN kind = 'distrust' THEN value ELSE -value END) AS excess FROM waves GROUP BY host)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN excess > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict FROM judged LEFT JOIN standing USING (host)"""

_LOWER = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = "regexp_extract_all(" + _LOWER.format(t="text") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP4 = f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_BENCH_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_BENCH_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least({WINDOW}, len(w)) AS width FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, width, w[p:p + width - 1] AS span FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS p FROM sized)),
places AS (
  SELECT row, p, width, w[p:p + width - 1] AS span
  FROM (SELECT row, w, width, unnest(range(1, len(w) - width + 2)) AS p FROM d, (SELECT DISTINCT width FROM windows) WHERE len(w) >= width)),
hits AS (SELECT row, p, width, item FROM places JOIN windows USING (width, span)),
covered AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(p, p + width)) AS place FROM hits) GROUP BY row),
items AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AND {SHARE} * coalesce(c.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered c USING (row) LEFT JOIN items i USING (row)"""

OP5 = f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
usable AS (
  SELECT row, vec_id, x, len(x) AS size, sqrt(list_dot_product(x, x)) AS norm FROM v
  WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
pairs AS (
  SELECT a.row AS a, b.row AS b FROM usable a JOIN usable b ON a.size = b.size AND a.row < b.row
  WHERE list_dot_product(a.x, b.x) / (a.norm * b.norm) >= {COSINE}::DOUBLE),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
found(node, other) AS (SELECT row, row FROM v UNION SELECT f.node, l.b FROM found f JOIN links l ON f.other = l.a),
least AS (SELECT node, min(vec_id) AS component_id FROM found JOIN v ON v.row = other GROUP BY node),
counts AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN least ON node = row LEFT JOIN counts USING (row)"""

OP8 = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER.format(t="text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sized AS (SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - {WORDS} + 1, 1) + 1), lambda p: w[p:p + {WORDS} - 1])) END AS s FROM d),
shingles AS (SELECT row, unnest(s) AS shingle FROM sized),
common AS (SELECT a.row AS a, b.row AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row < b.row GROUP BY ALL),
pairs AS (SELECT a, b FROM common JOIN sized x ON x.row = a JOIN sized y ON y.row = b WHERE 100 * n >= {PERCENT} * (len(x.s) + len(y.s) - n)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
found(node, other) AS (SELECT row, row FROM d UNION SELECT f.node, l.b FROM found f JOIN links l ON f.other = l.a),
least AS (SELECT node, min(doc_id) AS component_id FROM found JOIN d ON d.row = other GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sized JOIN least ON node = row"""

ORACLE = {"op4_decontaminate": OP4, "op5_embeddings": OP5, "op8_jaccard": OP8, "op11_filter_audit": OP11, "op12_prefix_trie": OP12, "op13_url_filter": OP13}
