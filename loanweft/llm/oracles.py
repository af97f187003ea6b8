"""SQL for DuckDB that gives the rows of this subpackage's queries, where SQL can express them."""

# crc32 by its table; trees level by level; a leaf's way is a list of "left|right", folded from the leaf on
MERKLE = """
WITH RECURSIVE bits AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS known
  FROM (SELECT unnest(range(256)) AS n)),
rows AS (
  SELECT doc_id, source, text, '' AS nothing,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda c, b: xor(c >> 8, known[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0 AS tampered
  FROM documents, bits),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claim
  FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position, count(*) OVER (PARTITION BY source) AS total FROM leaves),
nodes AS (
  SELECT source, 0 AS level, position, total, leaf AS digest FROM placed
  UNION ALL
  SELECT source, any_value(level) + 1, position // 3, any_value(total + 2) // 3, sha256(string_agg(digest, '' ORDER BY position)) FROM nodes WHERE total > 1 GROUP BY source, position // 3),
tops AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS position, count(*) OVER () AS total FROM nodes WHERE total = 1),
upper_nodes AS (
  SELECT 0 AS level, position, total, subroot AS digest FROM tops
  UNION ALL
  SELECT any_value(level) + 1, position // 3, any_value(total + 2) // 3, sha256(string_agg(digest, '' ORDER BY position)) FROM upper_nodes WHERE total > 1 GROUP BY position // 3),
steps AS (
  SELECT n.source, n.level, n.position, coalesce(string_agg(o.digest, '' ORDER BY o.position) FILTER (o.position < n.position), '') AS low,
    coalesce(string_agg(o.digest, '' ORDER BY o.position) FILTER (o.position > n.position), '') AS high
  FROM nodes n JOIN nodes o ON n.source IS NOT DISTINCT FROM o.source AND n.level = o.level AND n.position // 3 = o.position // 3
  WHERE n.total > 1 GROUP BY ALL),
upper_steps AS (
  SELECT n.level, n.position, coalesce(string_agg(o.digest, '' ORDER BY o.position) FILTER (o.position < n.position), '') AS low,
    coalesce(string_agg(o.digest, '' ORDER BY o.position) FILTER (o.position > n.position), '') AS high
  FROM upper_nodes n JOIN upper_nodes o ON n.level = o.level AND n.position // 3 = o.position // 3 WHERE n.total > 1 GROUP BY ALL),
upper_ways AS (
  SELECT t.source, t.subroot, list(low || '|' || high ORDER BY level) FILTER (level IS NOT NULL) AS way
  FROM tops t LEFT JOIN upper_steps s ON s.position = t.position // (3 ** s.level)::BIGINT GROUP BY t.source, t.subroot),
ways AS (
  SELECT p.source, p.position, list(low || '|' || high ORDER BY level) FILTER (level IS NOT NULL) AS way
  FROM placed p LEFT JOIN steps s ON s.source IS NOT DISTINCT FROM p.source AND s.position = p.position // (3 ** s.level)::BIGINT GROUP BY p.source, p.position),
audited AS (
  SELECT p.doc_id, p.leaf, u.subroot, (SELECT digest FROM upper_nodes WHERE total = 1) AS root,
    list_concat(coalesce(w.way, []), coalesce(u.way, [])) AS way, p.claim
  FROM placed p JOIN ways w ON w.source IS NOT DISTINCT FROM p.source AND w.position = p.position JOIN upper_ways u ON u.source IS NOT DISTINCT FROM p.source),
folded AS (
  SELECT *, list_reduce(list_prepend(claim, way), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root FROM audited)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(way, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
