"""Expected results in SQL of the queries that SQL can express."""

from __future__ import annotations

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# 20 bits of the digest at a time, as five hex digits and as four of base 32.
_BASE32 = f"""array_to_string(list_transform(range(0, 32), lambda i: substr('{_DIGITS}',
  1 + (((('0x' || substr(x, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '')"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Kind, its place in the order, pattern, and the group that holds the value.
_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2),
    ("access", "AKIA[A-Z0-9]+", 0),
    ("hex", "[0-9a-f]{16,}", 0),
    ("opaque", "[A-Za-z0-9+/_-]{20,}", 0),
)
_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, string_split_regex(t, '{pattern}') AS gaps, "
    f"regexp_extract_all(t, '{pattern}') AS hits, regexp_extract_all(t, '{pattern}', {group}) AS vals "
    f"FROM t WHERE regexp_matches(t, '{pattern}')"
    for rank, (kind, pattern, group) in enumerate(_KINDS)
)
_SIZE = "coalesce(list_sum(list_transform({}, lambda g: length(g))), 0)".format
_LISTED = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank, b)"

SQL: dict[str, str] = {
    "op4_secret_ownership": f"""WITH t AS MATERIALIZED (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
m AS MATERIALIZED ({_MATCHES}),
p AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS MATERIALIZED (SELECT doc_id, source, kind, rank, vals[i] AS value, length(hits[i]) AS n,
  ({_SIZE('gaps[1:i]')} + {_SIZE('hits[1:i - 1]')})::BIGINT AS a FROM p
  WHERE CASE kind WHEN 'assign' THEN length(vals[i]) >= 12 WHEN 'access' THEN length(hits[i]) >= 18
    WHEN 'opaque' THEN regexp_matches(hits[i], '[A-Za-z]') AND regexp_matches(hits[i], '[0-9]') ELSE true END),
own AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) >= 3 OR count(DISTINCT doc_id) >= 50 AS example FROM s GROUP BY value),
f AS MATERIALIZED (SELECT s.*, a + n AS b, example, s.kind <> 'opaque' AS base FROM s JOIN own USING (value)),
kept AS MATERIALIZED (SELECT * FROM f WHERE base OR (NOT example AND NOT EXISTS (SELECT 1 FROM f g
  WHERE g.doc_id = f.doc_id AND g.base AND g.a <= f.a AND g.b >= f.b))),
d AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex, {_LISTED} FILTER (WHERE base) AS base_spans, {_LISTED} AS spans,
  count(*) FILTER (WHERE NOT example) AS n_owned, count(*) FILTER (WHERE example) AS n_example FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0)::BIGINT AS n_owned,
  coalesce(n_example, 0)::BIGINT AS n_example FROM t LEFT JOIN d USING (doc_id)""",
    "op1_warc_chunks": f"""WITH p AS MATERIALIZED (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
n AS (SELECT x, max(page_id) AS newest FROM p GROUP BY x)
SELECT page_id, strlen(h) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to, true AS intact
FROM p JOIN n USING (x)""",
    "op2_winnowing": f"""WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, k, array_to_string(w[a : a + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS a FROM i)),
grams AS (SELECT doc_id, k, a, array_to_string(w[a : a + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM d JOIN (SELECT DISTINCT k FROM windows) ON len(w) >= k)),
hits AS MATERIALIZED (SELECT doc_id, item_id, a, k FROM grams JOIN windows USING (k, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM
  (SELECT doc_id, unnest(range(a, a + k)) AS p FROM (SELECT DISTINCT doc_id, a, k FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_collocations": f"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents),
p AS (SELECT doc, lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT row_number() OVER () AS piece, lang, words FROM (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p) WHERE len(words) > 0),
size AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, words[i:i + k - 1] AS words FROM (SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(words, ' ') AS phrase, any_value(words) AS words, count(*)::HUGEINT AS a
  FROM g GROUP BY lang, k, array_to_string(words, ' ') HAVING count(*) >= 100),
inside AS (SELECT DISTINCT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, a FROM (
  SELECT lang, words, k, a, m, unnest(range(1, k - m + 2)) AS i FROM f, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)),
c AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = f.lang AND i.phrase = f.phrase AND i.a >= f.a)),
cuts AS (SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, n, 1000 * c.a * n // (l.a * r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN size USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[j + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000""",
    # Pages of the given tables mark their main text by one article tag; a page without one has none here.
    "op13_block_labels": r"""WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(t, '</?(?:p|h1)>'),
  lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g'),
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS blocks FROM a),
c AS (SELECT page_id, url, coalesce(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c""",
}
