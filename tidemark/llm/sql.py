"""SQL that states results, for DuckDB, where it can express them."""

from __future__ import annotations

from tidemark.llm import quality

_PHRASES = "|".join(quality.BOILERPLATE)
_ENDS = quality.ENDS.replace("'", "''")

OP7 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
grams AS (
  SELECT r, i, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
lines AS (
  SELECT r, l, list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS lw
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT r, l, len(lw) AS n,
         100 * len(list_filter(lw, lambda w: regexp_matches(w, '[#*$%&|<>]|!!'))) > {quality.MOST_MARKED} * len(lw)
         OR (len(lw) <= {quality.NAVIGATION_WORDS} AND NOT contains('{_ENDS}', right(lw[-1], 1)))
         OR 100 * len(list_filter(lw, lambda w: w IN ('|', '>', '/', '·', '•', '»', '›'))) > {quality.MOST_MARKED} * len(lw)
 AS fails,
         regexp_matches(l, '(?i){_PHRASES}') AS boiler
  FROM lines),
by_doc AS (
  SELECT r, count(*) - count(DISTINCT l) AS dups, coalesce(sum(n) FILTER (WHERE NOT boiler AND NOT fails), 0) AS left_words,
         coalesce(sum(n) FILTER (WHERE boiler OR fails), 0) AS failed_words
  FROM judged GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(left_words, 0) AS left_words, coalesce(failed_words, 0) AS failed_words
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN by_doc USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words)
       AND left_words > 0 AND 100 * left_words >= {quality.LEAST_LEFT} * (left_words + failed_words) AS kept
FROM counted
"""

OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+2], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * shared >= 90 * (p.n + q.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT *, CASE WHEN strlen(body) >= 100 THEN min(page_id) OVER (PARTITION BY body) END AS first FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

OP12 = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS us,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM h),
c AS (
  SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain
  FROM u),
p AS (
  SELECT *, array_to_string(us[1:a], '') AS pre, array_to_string(us[a + 1:b], '') AS mid, array_to_string(us[b + 1:], '') AS suf,
         CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN NOT plain THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                        ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

OP13 = (
    OP2.replace("ws[i:i+2]", "ws[i:i+4]")
    .replace("greatest(len(ws) - 1, 2)", "greatest(len(ws) - 3, 2)")
    .replace("90 * (", "85 * (")
    .replace("AS n_shingles, component_id", "AS n_shingles, component_id, doc_id = component_id AS kept")
)

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM d)),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS nn FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
sums AS (SELECT lang, source, coalesce(sum(n), 0) AS nn FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (s.nn + 2 * v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 2)) // (l.nn + 2 * v) AS q
  FROM sums s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
priced AS (
  SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
parts AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN priced z ON z.lang = x.lang AND z.source = x.source AND z.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
