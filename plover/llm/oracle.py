"""DuckDB SQL twins of the queries that SQL can express."""

from plover.llm.queries import PROBE

OP1 = r"""
WITH c AS (
  SELECT DISTINCT page_id, url, DATE '2024-01-01' + CAST(((page_id * 37) % 366 + 366) % 366 AS INTEGER) AS fetched,
         regexp_replace(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1),
                                             '^.*@|:[0-9]*$', '', 'g')), '\.$', '', 'g') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
h AS (
  SELECT DISTINCT host, regexp_extract(path, '^/([^/]+)', 1) AS part,
         DATE '2023-10-01' + (('0x' || substr(md5(host), 1, 4))::INTEGER % 400)::INTEGER AS start,
         ('0x' || substr(md5(host), 9, 2))::INTEGER AS draw, contains(host, '-') AS pairs
  FROM c WHERE host <> ''),
e AS (
  SELECT host AS pattern, 'spam' AS category, start + d AS day, act FROM h, (VALUES (0, 'add'), (45, 'remove'), (90, 'add')) v(d, act)
  WHERE pairs
  UNION
  SELECT host || '/' || part, 'path', start + d, act FROM h, (VALUES (0, 'add'), (120, 'remove')) v(d, act)
  WHERE NOT pairs AND draw % 8 = 0 AND part <> ''
  UNION
  SELECT regexp_replace(host, '^[^.]+\.', ''), 'domain', start + d, act FROM h, (VALUES (0, 'add'), (7, 'remove')) v(d, act)
  WHERE NOT pairs AND NOT (draw % 8 = 0 AND part <> '') AND draw % 32 = 1),
last AS (SELECT pattern, category, day, max(act = 'remove') AS gone FROM e GROUP BY ALL),
k AS (
  SELECT c.*, unnest(list_distinct(list_concat(
    [array_to_string(list_slice(string_split(host, '.'), i, 99), '.')
     FOR i IN range(1, greatest(len(string_split(host, '.')), 2))],
    [host || '/' || array_to_string(list_slice([p FOR p IN string_split(path, '/') IF p <> ''], 1, i), '/')
     FOR i IN range(1, len([p FOR p IN string_split(path, '/') IF p <> '']) + 1)]))) AS key
  FROM c WHERE host <> ''),
-- the state of each list pattern is what its latest entry up to the fetch day says
state AS (
  SELECT k.page_id, k.url, k.fetched, l.pattern, l.category, max(l.day) AS day, arg_max(l.gone, l.day) AS gone
  FROM k JOIN last l ON l.pattern = k.key AND l.day <= k.fetched GROUP BY ALL),
-- an active entry began with the first add after the last removal
act AS (
  SELECT s.page_id, s.url, s.fetched, s.pattern, s.category,
         (SELECT min(a.day) FROM last a WHERE a.pattern = s.pattern AND a.category = s.category AND NOT a.gone
            AND a.day <= s.fetched AND a.day > coalesce((SELECT max(r.day) FROM last r WHERE r.pattern = s.pattern
              AND r.category = s.category AND r.gone AND r.day <= s.fetched), DATE '0001-01-01')) AS valid_from
  FROM state s WHERE NOT gone),
best AS (
  SELECT page_id, url, fetched, count(*) AS n_entries,
         min({'l': -length(pattern), 'c': category, 'p': pattern, 'f': valid_from}) AS b FROM act GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched, b.b IS NOT NULL AS blocked, coalesce(b.n_entries, 0) AS n_entries,
       b.b.c AS category, b.b.p AS pattern, b.b.f AS valid_from
FROM c LEFT JOIN best b ON c.page_id IS NOT DISTINCT FROM b.page_id AND c.url = b.url AND c.fetched = b.fetched
"""

OP2 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
t AS (
  SELECT *, length(role) + length(text) + 14
    + (length(role) - length(replace(role, '\\', ''))) + (length(role) - length(replace(role, ':', '')))
    + (length(role) - length(replace(role, '###', ''))) // 3 + (length(role) - length(replace(role, '</turn>', ''))) // 7
    + (length(text) - length(replace(text, '\\', ''))) + (length(text) - length(replace(text, '###', ''))) // 3
    + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS shown
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         [w FOR w IN regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') IF w <> ''] AS w FROM documents),
s AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
n AS (SELECT r, i, count(*) OVER (PARTITION BY array_to_string(list_slice(w, i, i + 34), ' ')) AS n FROM s),
gone AS (SELECT DISTINCT r, i + k AS i FROM n, range(35) x(k) WHERE n > 1),
word AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (
  SELECT word.r, count(gone.i) AS n_removed,
         string_agg(word, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS text
  FROM word LEFT JOIN gone ON gone.r = word.r AND gone.i = word.i GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

# crc32 of the decimal id, bit by bit (reflected polynomial 0xEDB88320)
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
  lambda a, x: list_reduce(list_concat([xor(a, x)], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

OP11 = f"""
WITH t AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         length(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, pos, id, size FROM c JOIN o ON o.conv_id = c.base AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, id, size FROM c JOIN o ON o.conv_id = c.conv_id AND pos > h),
p AS (
  SELECT conv_id, row_number() OVER w AS d, size, string_agg(id, '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
node AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, min(size) AS size FROM p GROUP BY path, d),
below AS (
  SELECT a.path, sum((node.n - 1) * node.size) AS saved,
         count(*) FILTER (NOT EXISTS (SELECT 1 FROM node k WHERE k.d = node.d + 1 AND left(k.path, 32 * node.d) = node.path)) AS leaves
  FROM node JOIN p a ON a.conv_id = node.conv_id AND a.d <= node.d GROUP BY a.path),
kids AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
ended AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM p WHERE d = (SELECT max(d) FROM p q WHERE q.conv_id = p.conv_id) GROUP BY path)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(ended.sha, sha256('')) AS ends_sha256
FROM node JOIN below USING (path) LEFT JOIN kids USING (path) LEFT JOIN ended USING (path)
LEFT JOIN node up ON up.d = node.d - 1 AND up.path = left(node.path, 32 * (node.d - 1))
"""

OP12 = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label OR a.v <> b.v)),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""

Q = {"op1_url_filter": OP1, "op2_chat_format": OP2, "op3_substring_dedup": OP3, "op11_prefix_trie": OP11,
     "op12_hard_negatives": OP12}
