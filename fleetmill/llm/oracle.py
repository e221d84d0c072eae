"""The queries that SQL can express, for DuckDB over the same tables."""

PHRASES = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase FROM pieces, range(1, 6) AS ks(k))
  GROUP BY ALL
), candidates AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM grams WHERE k >= 2 AND f >= 100
), covered AS (
  SELECT DISTINCT c.lang, c.phrase
  FROM candidates c JOIN candidates d ON d.lang = c.lang AND d.k > c.k AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= 100 * c.a
), cuts AS (
  SELECT c.lang, c.phrase, c.a, h, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.a * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS h FROM candidates) c
  JOIN totals t ON t.lang = c.lang
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, c.h), ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, c.h + 1, c.k), ' ')
  WHERE NOT EXISTS (SELECT 1 FROM covered x WHERE x.lang = c.lang AND x.phrase = c.phrase)
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
WHERE rank <= 2000
"""

TRIE = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda crc, b: list_reduce(range(8), lambda v, j: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, b)), 4294967295), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d
  FROM (
    SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM ids c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.i, t.role, t.text FROM ids c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h
  )
), whole AS (
  SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.d) FILTER (WHERE r.d IS NOT NULL), []) AS s
  FROM ids c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id
), member AS (
  SELECT conv_id AS c, len(s) AS turns, unnest(range(0, len(s) + 1)) AS depth, s FROM whole
), prefixes AS (
  SELECT depth, s[:depth] AS prefix, c, turns FROM member
), nodes AS (
  SELECT min(c) AS conv_id, depth, prefix, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE turns = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(prefix[depth].text) END AS saved
  FROM prefixes GROUP BY depth, prefix
), parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[:n.depth - 1]
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL
), every AS (
  SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM parents p LEFT JOIN children c ON c.conv_id = p.conv_id AND c.depth = p.depth
), sums AS (
  SELECT a.conv_id, a.depth, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS at FROM every) b
  JOIN every a ON a.depth = b.at AND a.prefix = b.prefix[:b.at]
  GROUP BY ALL
)
SELECT e.conv_id, e.depth, e.parent_conv_id, e.n_convs, e.n_children, s.n_leaves, s.saved_tokens, e.ends_sha256
FROM every e JOIN sums s ON s.conv_id = e.conv_id AND s.depth = e.depth
"""
