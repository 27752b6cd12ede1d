"""DuckDB SQL for the operators that SQL can express, written from their contracts and not from the operators."""

COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM words),
found AS (SELECT lang, unnest([array_to_string(w[p : p + k - 1], ' ') FOR k IN range(1, 6) IF p + k - 1 <= len(w)]) AS phrase FROM starts),
f AS (SELECT lang, phrase, count(*) AS f FROM found GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE contains(phrase, ' ')),
inner_parts AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i : j], ' ') AS phrase, c.a
  FROM cand c, unnest(range(1, len(c.w))) AS x(i), unnest(range(2, len(c.w) + 1)) AS y(j)
  WHERE j > i AND j - i + 1 < len(c.w)),
free AS (
  SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 100 * c.a)),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n.n, (1000 * c.a::HUGEINT * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM free c, unnest(range(1, len(c.w))) AS u(k), f x, f y, n
  WHERE x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
    AND y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ') AND n.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""

NEAR_VECTORS = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98),
reached(vec_id, spot) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.spot)
SELECT e.vec_id, coalesce((SELECT count(*) FROM links l WHERE l.a = e.vec_id), 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(spot) AS component_id FROM reached GROUP BY vec_id) c USING (vec_id)
"""

PREFIX_TRIE = """
WITH given AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM given)),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM (
    SELECT c.conv_id, 0 AS part, g.pos, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.base AND g.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1, g.pos, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.conv_id AND g.pos > c.h)),
members AS (
  SELECT conv_id, depth, strlen(text) AS bytes, string_agg(md5(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS size FROM members GROUP BY conv_id),
nodes AS (
  SELECT path, any_value(depth) AS depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, bool_and(depth = size) AS childless,
    sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256
  FROM members m JOIN lengths USING (conv_id) GROUP BY path),
below AS (
  SELECT m.path, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n.childless) AS n_leaves
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.path),
parents AS (SELECT n.path, p.path AS parent, p.conv_id AS parent_conv_id FROM nodes n JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, 32 * (n.depth - 1)::INTEGER)),
children AS (SELECT parent AS path, count(*) AS n_children FROM parents GROUP BY parent)
SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN parents p USING (path) LEFT JOIN children c USING (path)
"""
