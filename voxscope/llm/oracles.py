"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from .quality_rules import MAX_REPEAT_PERCENT, MAX_SHARE, MIN_DOCS, MIN_LEFT, MIN_WORDS
from .substring_dedup import WINDOW
from .url_rules import PATTERNS, SITE_RULES, pattern_regex

_WORD, _BLANKS = r"'[^\x20\x09-\x0D]+'", r"'[\x20\x09-\x0D]+'"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_WORDS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, regexp_extract_all(text, {_WORD}) AS ws FROM d),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
"""

QUALITY_RULES = _WORDS + f"""
tri AS (SELECT rid, i, w, lead(w) OVER q AS b, lead(w, 2) OVER q AS c FROM w WINDOW q AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM tri WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w, b, c) > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) t(k) GROUP BY rid),
sizes AS (SELECT rid, count(*) AS n, sum(length(w)) AS chars FROM w GROUP BY rid),
lines AS (SELECT rid, source, text, line, lower(trim(regexp_replace(line, {_BLANKS}, ' ', 'g'))) AS norm,
 len(regexp_extract_all(line, {_WORD})) AS n
 FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, {_WORD})),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
bad AS (SELECT x.source, norm FROM (SELECT source, norm, count(DISTINCT text) AS n FROM lines GROUP BY source, norm) x
 JOIN hosts h ON x.source IS NOT DISTINCT FROM h.source WHERE n >= {MIN_DOCS} AND n > docs * {MAX_SHARE}),
per AS (SELECT rid, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN EXISTS (SELECT 1 FROM bad b
 WHERE b.norm = lines.norm AND b.source IS NOT DISTINCT FROM lines.source) THEN n ELSE 0 END) AS lost FROM lines GROUP BY rid),
c AS (SELECT d.doc_id, coalesce(s.n, 0) AS n_words, coalesce(s.chars, 0) AS word_chars,
 length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
 coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
 FROM d LEFT JOIN sizes s USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN per USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
 CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
 NOT base_failed AND n_words - lost >= n_words * {MIN_LEFT} AS kept FROM f"""

SUBSTRING_DEDUP = _WORDS + f"""
win AS (SELECT rid, i, array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ') AS x
 FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM l WHERE len(ws) >= {WINDOW})),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY x) > 1),
gone AS (SELECT DISTINCT rid, i + k AS i FROM rep, (SELECT unnest(range({WINDOW})) AS k)),
kept AS (SELECT w.rid, count(*) AS n, string_agg(w.w, ' ' ORDER BY w.i) AS x FROM w ANTI JOIN gone g ON g.rid = w.rid AND g.i = w.i GROUP BY w.rid)
SELECT l.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
 sha256(coalesce(k.x, '')) AS kept_sha256 FROM l LEFT JOIN kept k USING (rid)"""

_HOST, _UPPER, _LOWER = r"'(?s)^.*?://([^/?#]*)([^?#]*)'", "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_SITES = ", ".join(f"({k}, {_text(s.verdict)}, {_text(s.host)}, {_text(s.path)})" for k, s in enumerate(SITE_RULES))
_BLOCK = " OR ".join(f"regexp_matches(host || path, {_text(pattern_regex(p))})" for p in PATTERNS if not p.startswith("@@"))
_EXCUSE = " OR ".join(f"regexp_matches(host || path, {_text(pattern_regex(p[2:]))})" for p in PATTERNS if p.startswith("@@"))

URL_RULES = f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, translate(coalesce(regexp_extract(url, {_HOST}, 1), ''), {_UPPER}, {_LOWER}) AS host,
 coalesce(regexp_extract(url, {_HOST}, 2), '') AS path FROM pages),
best AS (SELECT rid, first(r.host || r.path ORDER BY length(r.host || r.path) DESC, no) AS rule,
 first(verdict ORDER BY length(r.host || r.path) DESC, no) AS verdict
 FROM p, (VALUES {_SITES}) r(no, verdict, host, path)
 WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN ({_BLOCK}) AND NOT ({_EXCUSE}) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (rid)"""

JACCARD_JOIN = f"""
WITH RECURSIVE l AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), {_WORD}) AS ws FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(list_slice(ws, i, i + 2), ' ') AS x
 FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM l WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
e AS (SELECT c.a, c.b FROM (SELECT p.rid AS a, q.rid AS b, count(*) AS c FROM s p JOIN s q USING (x) WHERE p.rid != q.rid GROUP BY p.rid, q.rid) c
 JOIN n y ON y.rid = c.a JOIN n z ON z.rid = c.b WHERE 100 * c.c >= 90 * (y.n + z.n - c.c)),
r(a, b) AS (SELECT rid, rid FROM l UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT l.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id FROM l LEFT JOIN n USING (rid)
JOIN (SELECT r.a AS rid, min(o.doc_id) AS component_id FROM r JOIN l o ON o.rid = r.b GROUP BY r.a) m USING (rid)"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

RANKED_SEARCH = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), {_TERM}) AS ws FROM documents),
d AS (SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n, ws FROM t WHERE len(ws) > 0),
g AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM d),
tf AS (SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY rid, w),
wt AS (SELECT w, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
 FROM tf, g GROUP BY w, n_docs),
b AS (SELECT row_number() OVER () AS no, item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), {_TERM}) AS ws FROM benchmark),
it AS (SELECT no, item_id, w, count(*) AS times FROM (SELECT no, item_id, unnest(ws) AS w FROM b) GROUP BY no, item_id, w),
s AS (SELECT no, item_id, rid, doc_id,
 CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // all_terms)))) AS BIGINT) AS score
 FROM it JOIN tf USING (w) JOIN wt USING (w) JOIN d USING (rid), g GROUP BY no, item_id, rid, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20"""
