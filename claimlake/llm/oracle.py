"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP9 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP13 = """
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), numbered AS (
  SELECT *, xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
  ), 4294967295) % 9 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS t
  FROM numbered c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, t[1:d] AS node, CAST(d AS BIGINT) AS depth, d = len(t) AS ends_here
  FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN depth > 0 THEN strlen(node[depth].text) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends_here), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), grown AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)
), subtrees AS (
  SELECT node[1:d] AS node, sum(saved) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM grown) GROUP BY ALL
)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, g.ends_sha256
FROM grown g JOIN subtrees s USING (node) LEFT JOIN grown p ON g.depth > 0 AND p.node = g.node[1:g.depth - 1]
"""

ORACLE: dict[str, str] = {"op9_topk": OP9, "op13_prefix_trie": OP13}
