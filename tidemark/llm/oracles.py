"""DuckDB SQL of the queries of this subpackage that SQL can express."""

_COMPONENTS = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
walk(id, got) AS (SELECT id, id FROM sets UNION SELECT w.id, r.b FROM walk w JOIN reach r ON r.a = w.got)
"""

OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id AS id, list_distinct(list_transform(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM d),
one AS (SELECT id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (SELECT p.id AS a, q.id AS b FROM one p JOIN one q ON p.x = q.x AND p.id < q.id GROUP BY p.id, q.id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
{_COMPONENTS}
SELECT s.id AS doc_id, len(s.s)::BIGINT AS n_shingles, min(w.got) AS component_id, s.id = min(w.got) AS kept
FROM sets s JOIN walk w ON w.id = s.id GROUP BY s.id, len(s.s)
"""

OP3 = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""

OP8 = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
lens AS (SELECT DISTINCT least(10, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
runs AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT runs.doc_id, runs.i, runs.n, win.item_id FROM runs JOIN win ON runs.n = win.n AND runs.x = win.x),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS s FROM m WHERE item_id IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(s), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(s, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_MARKS = "'^([ \\t]*>)+[ \\t]?'"
_NORM = "regexp_replace(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\r\\x0b\\f]+', ' ', 'g'), '^ | $', '', 'g')"

_LINK_CTES = f"""
m AS (SELECT row_number() OVER () AS rid, conv_id AS conv, turn, role, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') AS text FROM {{source}}),
ln AS (SELECT rid, conv, turn, i, x, regexp_extract(x, {_MARKS}) AS mark FROM (SELECT rid, conv, turn, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m)),
lv AS (SELECT rid, conv, turn, i, length(regexp_replace(mark, '[ \\t]', '', 'g')) AS level, substr(x, length(mark) + 1) AS body FROM ln),
fr AS (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY rid ORDER BY i) THEN 1 ELSE 0 END AS fresh FROM lv),
nr AS (SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM fr),
runs AS (SELECT rid, conv, turn, run, level, string_agg(body, chr(10) ORDER BY i) AS text FROM nr GROUP BY ALL),
replies AS (SELECT rid, regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (WHERE level = 0), ''), '^[ \\t\\n\\r\\x0b\\f]+|[ \\t\\n\\r\\x0b\\f]+$', '', 'g') AS reply FROM lv GROUP BY rid),
quoted AS (SELECT DISTINCT conv, turn, run, level, text FROM runs WHERE level > 0 AND conv IS NOT NULL AND turn IS NOT NULL AND {_NORM.format("text")} <> ''),
pieces AS (SELECT DISTINCT conv, turn, run, level, text, norm FROM (SELECT *, {_NORM.format("piece")} AS norm FROM (SELECT *, unnest(list_concat([text], string_split(text, chr(10)))) AS piece FROM quoted)) WHERE norm <> ''),
own AS (SELECT DISTINCT conv, turn, norm FROM (SELECT conv, turn, {_NORM.format("piece")} AS norm FROM (
  SELECT conv, turn, text AS piece FROM runs WHERE level = 0 UNION ALL SELECT conv, turn, body FROM lv WHERE level = 0 UNION ALL SELECT m.conv, m.turn, reply FROM replies JOIN m USING (rid))) WHERE norm <> '' AND conv IS NOT NULL AND turn IS NOT NULL),
here AS (SELECT p.conv, p.turn, p.norm, max(o.turn) AS found FROM (SELECT DISTINCT conv, turn, norm FROM pieces) p JOIN own o ON o.conv = p.conv AND o.norm = p.norm AND o.turn < p.turn GROUP BY ALL),
first_ AS (SELECT norm, min((conv, turn)) AS f FROM own GROUP BY norm),
met AS (SELECT p.*, h.found IS NOT NULL AS kin, CASE WHEN h.found IS NOT NULL THEN (p.conv, h.found) WHEN f.f <> (p.conv, p.turn) THEN f.f END AS source
  FROM pieces p LEFT JOIN here h USING (conv, turn, norm) LEFT JOIN first_ f USING (norm)),
linked AS (SELECT conv, turn, count(DISTINCT (run, level, text)) AS n_linked, max((-level, kin, length(norm), source[2], source[1])) AS best, max((-level, kin, length(norm), source[2], source[1])) FILTER (WHERE kin) AS near FROM met WHERE source IS NOT NULL GROUP BY conv, turn),
walk(conv, turn, up, depth) AS (SELECT conv, turn, near[4], 1 FROM linked WHERE near IS NOT NULL UNION ALL SELECT w.conv, w.turn, l.near[4], w.depth + 1 FROM walk w JOIN linked l ON l.conv = w.conv AND l.turn = w.up AND l.near IS NOT NULL),
roots AS (SELECT conv, turn, min(up) AS root, max(depth) AS depth FROM walk GROUP BY conv, turn),
counts AS (SELECT conv, turn, count(*) AS n_quotes, max(level) AS max_level FROM quoted GROUP BY conv, turn)
"""

_MESSAGES = """
SELECT m.conv AS conv_id, m.turn, m.role, r.reply, coalesce(n_quotes, 0)::BIGINT AS n_quotes, coalesce(max_level, 0)::BIGINT AS max_level, coalesce(n_linked, 0)::BIGINT AS n_linked, near[4] AS parent_turn,
  coalesce(root, m.turn) AS thread_turn, coalesce(depth, 0)::BIGINT AS depth, best[5] AS source_conv, best[4] AS source_turn
FROM m JOIN replies r USING (rid) LEFT JOIN counts c ON c.conv = m.conv AND c.turn = m.turn LEFT JOIN linked l ON l.conv = m.conv AND l.turn = m.turn LEFT JOIN roots t ON t.conv = m.conv AND t.turn = m.turn
"""

#: One row a message of a table ``conversations`` that has quotes.
OP1_LINKS = f"WITH RECURSIVE {_LINK_CTES.format(source='conversations')} {_MESSAGES}"

_QUOTE = "'{1}' || replace({0}, chr(10), chr(10) || '{1}')"

OP1 = f"""
WITH RECURSIVE own_ AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
one_ AS (SELECT conv_id, turn, min(text) AS text FROM own_ GROUP BY conv_id, turn),
three AS (SELECT o.*, a.text AS back1, b.text AS back2, s.text AS other, ('0x' || substr(md5(o.conv_id || ':' || o.turn), 1, 6))::BIGINT % 8 AS k FROM own_ o
  LEFT JOIN one_ a ON a.conv_id = o.conv_id AND a.turn + 1 = o.turn LEFT JOIN one_ b ON b.conv_id = o.conv_id AND b.turn + 2 = o.turn LEFT JOIN one_ s ON s.conv_id - 1 = o.conv_id AND s.turn = 0),
quoting AS (SELECT conv_id, turn, role, CASE k
  WHEN 1 THEN concat_ws(chr(10), {_QUOTE.format("back1", "> ")}, text)
  WHEN 2 THEN concat_ws(chr(10), {_QUOTE.format("back2", ">> ")}, {_QUOTE.format("back1", "> ")}, text)
  WHEN 3 THEN concat_ws(chr(10), text, {_QUOTE.format("replace(translate(back1, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ', '  ')", ">")})
  WHEN 4 THEN concat_ws(chr(10), {_QUOTE.format("other", "> ")}, text)
  WHEN 5 THEN concat_ws(chr(10), '> never said ' || md5(text), text)
  WHEN 6 THEN concat_ws(chr(10), {_QUOTE.format("string_split(back1, chr(10))[1]", "> ")}, text)
  WHEN 7 THEN concat_ws(chr(10), {_QUOTE.format("back2", "> > ")}, text)
  ELSE text END AS text FROM three),
{_LINK_CTES.format(source="quoting")},
msg AS ({_MESSAGES})
SELECT conv_id, thread_turn, turn // 512 - thread_turn // 512 AS part, count(*) AS n_messages, sum(n_quotes)::BIGINT AS n_quotes, sum(n_linked)::BIGINT AS n_linked, max(depth) AS max_depth,
  string_agg(turn || ':' || coalesce(parent_turn::VARCHAR, '') || ':' || coalesce(source_conv::VARCHAR, '') || ':' || coalesce(source_turn::VARCHAR, ''), ' ' ORDER BY turn, role, reply) AS links,
  string_agg(coalesce(role, '') || ':' || reply, chr(10) || chr(10) ORDER BY turn, role, reply) AS dialogue
FROM msg GROUP BY ALL
"""

_NUMBER = "(('0x' || substr(md5({0}), 1, 6))::BIGINT % {1})"

_AT = "TIMESTAMP '2024-01-01 00:00:00' + INTERVAL ({0}) DAY + INTERVAL ({1}) HOUR"

OP10 = f"""
WITH c AS (SELECT page_id, url, {_AT.format(_NUMBER.format("'day ' || page_id", 365), _NUMBER.format("'hour ' || page_id", 24))} AS fetched,
  regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\\.+$', '') AS host FROM pages),
h AS (SELECT DISTINCT host AS key, {_NUMBER.format("host", 30030)} AS n FROM c WHERE host <> ''),
dm AS (SELECT DISTINCT key, {_NUMBER.format("'domain ' || key", 30030)} AS n FROM (SELECT regexp_extract(key, '([^.]+\\.[^.]+\\.[^.]+)$', 1) AS key FROM h) WHERE key <> ''),
e AS (SELECT key, 3 AS rank, {_AT.format("n % 200", "n % 24")} AS since FROM h WHERE n % 3 = 0
  UNION ALL SELECT key, 1, {_AT.format("n % 200 + 90", "n % 24")} FROM h WHERE n % 6 = 0
  UNION ALL SELECT key, 2, {_AT.format("n % 300", "n % 24")} FROM h WHERE n % 5 = 0
  UNION ALL SELECT key, 3, {_AT.format("182", "12")} FROM dm WHERE n % 7 = 0
  UNION ALL SELECT key, 3, {_AT.format("n % 250", "n % 24 % 12")} FROM h WHERE n % 4 = 0
  UNION ALL SELECT key, 2, {_AT.format("n % 250", "n % 24 % 12 + 6")} FROM h WHERE n % 4 = 0),
iv AS (SELECT key, rank, since AS valid_from, lead(since) OVER (PARTITION BY key ORDER BY since) AS valid_to FROM (SELECT key, since, max(rank) AS rank FROM e GROUP BY key, since)),
met AS (SELECT c.host, c.fetched, max((length(iv.key), iv.key, CASE rank WHEN 3 THEN 'block' ELSE 'allow' END, valid_from)) AS d
  FROM (SELECT DISTINCT host, fetched FROM c) c JOIN iv ON (c.host = iv.key OR ends_with(c.host, '.' || iv.key)) AND rank > 1 AND c.fetched >= valid_from AND (valid_to IS NULL OR c.fetched < valid_to) GROUP BY ALL)
SELECT page_id, url, c.fetched::VARCHAR AS fetched, c.host, coalesce(d[3] = 'block', false) AS blocked, d[2] AS key, d[3] AS action, d[4]::VARCHAR AS valid_from
FROM c LEFT JOIN met ON met.host = c.host AND met.fetched = c.fetched
"""

_NEAREST = """
a{0} AS MATERIALIZED (SELECT r, vec_id, v, min((d, k)) AS m FROM (SELECT v.*, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{0}) GROUP BY ALL)"""

_MEANS = """,
c{1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{0} c LEFT JOIN (SELECT k, list(f ORDER BY i) AS c FROM (
  SELECT k, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS f FROM (SELECT m[2] AS k, i, sum(x) AS s, count(*) AS n FROM (SELECT m, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{0}) GROUP BY ALL)) GROUP BY k) m USING (k)),"""

OP11 = (
    """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT k - 1 AS k, v AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) AS k FROM v) WHERE k <= 16),"""
    + "".join(_NEAREST.format(i) + _MEANS.format(i, i + 1) for i in range(3))
    + _NEAREST.format(3)
    + """
SELECT vec_id, m[2]::INTEGER AS cluster, m[1] AS distance, (sum(m[1]) OVER (PARTITION BY m[2]))::BIGINT AS cluster_inertia, (sum(m[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.k = m[2]
"""
)

OP13 = """
WITH c AS (SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
m AS (SELECT c, c - c % 100 AS base, xor(list_reduce(list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT),
    lambda crc, b: list_reduce(range(0, 8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(crc, b)), 4294967295::BIGINT), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT c, c::VARCHAR AS s FROM (SELECT DISTINCT c FROM c))),
r AS (SELECT m.c, x.i, x.role, x.text FROM m JOIN c x ON x.c = m.base AND x.i <= m.h UNION ALL SELECT m.c, x.i, x.role, x.text FROM m JOIN c x ON x.c = m.c AND x.i > m.h),
w AS (SELECT m.c, coalesce(t, []) AS t FROM m LEFT JOIN (SELECT c, list({'role': role, 'text': text} ORDER BY i) AS t FROM r GROUP BY c) USING (c)),
p AS (SELECT c, d, t[1:d] AS k, length(t[d].text) AS points, len(t) = d AS ends FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM w)),
n AS (SELECT k, d, min(c) AS conv_id, count(*) AS n, coalesce((count(*) - 1) * min(points), 0) AS w, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY k, d),
kid AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kid USING (k)),
up AS (SELECT k, sum(leaf) AS n_leaves, sum(w) AS saved FROM (SELECT k[1:unnest(range(0, d + 1))] AS k, (n_children = 0)::BIGINT AS leaf, w FROM f) GROUP BY k)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, up.n_leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN up USING (k) LEFT JOIN n q ON f.d > 0 AND q.d = f.d - 1 AND q.k = f.k[1:f.d - 1]
"""

#: As OP2 at 0.85, without the column kept.
OP12 = OP2.replace(">= 80 *", ">= 85 *").replace(", s.id = min(w.got) AS kept", "")
