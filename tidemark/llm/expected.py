"""Expected results of the operators' queries as SQL over the sample tables, where SQL can express them."""

from __future__ import annotations

OP2 = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, source, size, (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || '|' || size::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM (SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents)
), sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size AS cap, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::INT + 1] AS weight FROM sources
), levelled AS (
  SELECT *, row_number() OVER o AS place,
    ((sum(source_size) OVER ())::DOUBLE * 150 / 100 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight::DOUBLE, source IS NULL, source)
), final_level AS (SELECT arg_min(level, place) AS level FROM levelled WHERE cap > level * weight),
targets AS (
  SELECT source, source_size, target, copies, target - copies * source_size AS more,
    CASE WHEN source_size > 0 THEN (target - copies * source_size) / source_size ELSE 0 END AS p
  FROM (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies
    FROM (SELECT w.source, w.source_size, least(w.cap::DOUBLE, coalesce(l.level * w.weight, w.cap::DOUBLE)) AS target FROM weighed w LEFT JOIN final_level l ON true))
), ranked AS (
  SELECT doc_id, size, t.*, sum(size) OVER (PARTITION BY t.source ORDER BY CASE WHEN p > 0 THEN (u / (1 - u)) * ((1 - p) / p) ELSE 'inf'::DOUBLE END, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS upto
  FROM docs JOIN targets t ON docs.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN more > 0 AND (upto <= more OR (upto - size < more AND abs(upto - more) < abs(upto - size - more))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""

OP4 = r"""
WITH RECURSIVE rules(verdict, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
    ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), urls AS MATERIALIZED (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), places AS MATERIALIZED (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls
), fits AS (
  SELECT page_id, arg_min(rule, (-length(rule), rule)) AS rule, arg_min(verdict, (-length(rule), rule)) AS verdict
  FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
), links AS MATERIALIZED (
  SELECT source, target, count(*) AS links FROM (
    SELECT host AS source, translate(unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM places)
  WHERE source <> '' AND source <> target GROUP BY ALL
), edges AS MATERIALIZED (
  SELECT 'allow' AS kind, source AS f, target AS t, links / sum(links) OVER (PARTITION BY source) AS share FROM links
  UNION ALL SELECT 'block', target, source, links / sum(links) OVER (PARTITION BY target) FROM links
), flow AS (
  SELECT verdict AS kind, host, count(*)::DOUBLE AS mass, 0 AS step FROM places JOIN fits USING (page_id) GROUP BY ALL
  UNION ALL
  SELECT flow.kind, edges.t, sum(mass * share * 0.85), step + 1 FROM flow JOIN edges ON flow.kind = edges.kind AND flow.host = edges.f WHERE step < 20 GROUP BY ALL
), reached AS (
  SELECT host, sum(CASE WHEN kind = 'allow' THEN mass ELSE 0 END) AS trust, sum(CASE WHEN kind = 'block' THEN mass ELSE 0 END) AS distrust FROM flow GROUP BY host)
SELECT page_id, places.host, path, rule, coalesce(verdict, CASE WHEN coalesce(distrust, 0) > 2.0 * coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM places LEFT JOIN fits USING (page_id) LEFT JOIN reached ON places.host = reached.host
"""

OP5 = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
      ELSE [array_to_string(w, ' ')] END) AS s
    FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_reached AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(c, doc_id))::BIGINT AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON a = doc_id
"""

OP7 = r"""
WITH doc_words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS MATERIALIZED (
  SELECT doc_id, places.n, i, item_id FROM places JOIN windows ON places.n = windows.n AND places.t = windows.t
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP11 = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_key
    FROM conversations WHERE conv_id IS NOT NULL
),
talks AS (
    SELECT c, list(turn_key ORDER BY turn NULLS FIRST, role, turn_key) AS keys,
           list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY turn NULLS FIRST, role, turn_key) AS words
    FROM turns GROUP BY c
),
-- crc32 of the decimal id, bit by bit
digits AS (
    SELECT c, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT) AS bytes FROM talks
),
crc AS (
    SELECT c, 0 AS i, 4294967295::UBIGINT AS v, bytes FROM digits
    UNION ALL
    SELECT c, i + 1, list_reduce(list_concat([xor(v, bytes[i + 1])], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END), bytes
    FROM crc WHERE i < len(bytes)
),
shares AS (
    SELECT c, (xor(v, 4294967295::UBIGINT) % 4)::BIGINT AS h FROM crc WHERE i = len(bytes)
),
rebuilt AS (
    SELECT t.c, list_concat(coalesce(b.keys[1:h], []), t.keys[h + 1:]) AS keys, list_concat(coalesce(b.words[1:h], []), t.words[h + 1:]) AS words
    FROM talks t JOIN shares USING (c) LEFT JOIN talks b ON b.c = t.c - t.c % 20
),
nodes AS (
    SELECT keys[1:d] AS path, d, min(c) AS c, count(*) AS n, any_value(CASE WHEN d > 0 THEN words[d] ELSE 0 END) AS w,
           coalesce(list(c ORDER BY c) FILTER (len(keys) = d), []) AS ends
    FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS d FROM rebuilt) GROUP BY 1, 2
),
children AS (
    SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
),
below AS (
    SELECT path[1:k] AS path, sum((n_children IS NULL)::BIGINT) AS n_leaves, sum((n - 1) * w) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM nodes LEFT JOIN children USING (path)) GROUP BY 1
)
SELECT a.c AS conv_id, a.d AS depth, p.c AS parent_conv_id, a.n AS n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(array_to_string(a.ends, ',')) AS ends_sha256
FROM nodes a JOIN below USING (path) LEFT JOIN children USING (path) LEFT JOIN nodes p ON a.d > 0 AND p.path = a.path[1:a.d - 1]
"""

EXPECTED = {
    "op4_url_trust": OP4,
    "op2_source_mix": OP2,
    "op5_jaccard_join": OP5,
    "op7_decontaminate": OP7,
    "op11_prefix_trie": OP11,
}
