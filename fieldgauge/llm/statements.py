"""SQL of the same results, for the queries that SQL can state over whole tables."""

WORD = r"[^\x20\x09-\x0D]+"

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
placed AS (
  SELECT doc_id, i, row_number() OVER (
    PARTITION BY array_to_string(list_slice(w, i, i + 19), ' ') ORDER BY doc_id, i) AS nth
  FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM placed WHERE nth > 1),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n
  FROM each_word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

LINES = rf"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS body, generate_subscripts(ls, 1) AS line FROM d),
f AS (
  SELECT *, lead(body) OVER (PARTITION BY doc_id ORDER BY line) AS following,
    len(regexp_extract_all(body, '{WORD}')) >= 50 AS long
  FROM l WHERE trim(translate(body, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''),
r AS (
  SELECT *, following IS NOT NULL AND
      row_number() OVER (PARTITION BY body, following ORDER BY doc_id, line) > 1 AS pair,
    long AND row_number() OVER (PARTITION BY body ORDER BY doc_id, line) > 1 AS alone
  FROM f),
g AS (
  SELECT doc_id, line,
    pair OR alone OR coalesce(lag(pair) OVER (PARTITION BY doc_id ORDER BY line), false) AS gone FROM r),
kept AS (
  SELECT doc_id, string_agg(body, chr(10) ORDER BY line) AS body
  FROM l ANTI JOIN (SELECT * FROM g WHERE gone) USING (doc_id, line) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(x, 0)::BIGINT AS n_deleted,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS x FROM g GROUP BY doc_id) USING (doc_id)
"""

_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_PLAIN}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(list_slice(w, i, i + 12), ' ') AS body
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_PLAIN}') AS w FROM documents),
parts AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM d JOIN (SELECT DISTINCT size FROM windows) ON len(w) >= size),
met AS (
  SELECT doc_id, i, size, item_id
  FROM (SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS body FROM parts)
  JOIN windows USING (size, body)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM met) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM met) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
    coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s WINDOW o AS (ORDER BY 3.0 * source_size / weight, weight, source)),
level AS (
  SELECT (total - fixed)::DOUBLE / free AS rise FROM filled
  WHERE (total - fixed)::DOUBLE / free <= cap::DOUBLE / weight ORDER BY cap::DOUBLE / weight LIMIT 1),
t AS (SELECT source, source_size, least(cap::DOUBLE, weight * rise) AS target FROM filled, level),
placed AS (
  SELECT d.doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix' || coalesce(':' || d.source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS u,
    row_number() OVER (PARTITION BY d.source ORDER BY size, d.doc_id NULLS FIRST) - 1 AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(u + (i + 1) * rate) - floor(u + i * rate))::BIGINT * size)::BIGINT AS taken
FROM placed
"""

PREFERENCES = """
WITH last AS (
  SELECT conv_id, max(turn) AS at, arg_max(text, turn) AS answer
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
before AS (
  SELECT c.conv_id, count(*) AS n,
    string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS body
  FROM conversations c JOIN last USING (conv_id) WHERE c.turn < last.at GROUP BY c.conv_id),
pair AS (
  SELECT l.conv_id, coalesce(b.n, 0) AS n, coalesce(b.body, '') AS body, o.answer IS NOT DISTINCT FROM l.answer AS same,
    '<|assistant|>' || chr(10) || l.answer || '<|end|>' || chr(10) AS mine,
    coalesce('<|assistant|>' || chr(10) || o.answer || '<|end|>' || chr(10), '') AS lent
  FROM last l LEFT JOIN before b USING (conv_id) LEFT JOIN last o ON o.conv_id = xor(l.conv_id, 1::BIGINT))
SELECT conv_id, (n + same::BIGINT)::BIGINT AS n_prompt_turns, body || CASE WHEN same THEN mine ELSE '' END AS prompt,
  CASE WHEN same THEN '' ELSE mine END AS chosen, CASE WHEN same THEN '' ELSE '14:' || length(mine) END AS chosen_mask,
  CASE WHEN same THEN '' ELSE lent END AS rejected,
  CASE WHEN same OR lent = '' THEN '' ELSE '14:' || length(lent) END AS rejected_mask
FROM pair
"""

ARCHIVE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p),
d AS (
  SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, (5 * i + 1)::BIGINT, 5))::BIGINT) AS parts FROM f)
SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
  array_to_string(flatten(list_transform(parts, lambda x: list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)))), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS sound
FROM d
"""
