"""DuckDB SQL of op13's result, by joins of prefixes instead of shards."""

# crc32 of a decimal number, byte by byte and bit by bit (DuckDB has none).
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({id}::VARCHAR, ''), lambda x: ord(x)::BIGINT),
  lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id, turn, substr(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'d': digest, 'w': words}} ORDER BY turn NULLS FIRST, digest, words) AS t, {_CRC.format(id="conv_id")} % 4 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, coalesce(b.t[1:o.h], []) || o.t[o.h + 1:] AS t
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
entries AS (
  SELECT conv_id, depth, len(t) AS n, CASE WHEN depth = 0 THEN 0 ELSE t[depth].w END AS w,
    md5(array_to_string(list_transform(t[1:depth], lambda x: x.d), ',')) AS node,
    CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(t[1:depth - 1], lambda x: x.d), ',')) END AS parent
  FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT node, depth, parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(w) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM entries GROUP BY node, depth, parent),
kids AS (SELECT parent AS node, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (  -- each node with itself and all nodes over it, along one member
  SELECT DISTINCT n.node AS below, e.node
  FROM nodes n JOIN entries e ON e.conv_id = n.conv_id AND e.depth <= n.depth),
sums AS (
  SELECT a.node, sum(b.saved) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM above a JOIN nodes b ON b.node = a.below LEFT JOIN kids k ON k.node = b.node GROUP BY a.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.k, 0) AS n_children,
  s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.node = n.node
"""
