"""Queries over conversations."""

from __future__ import annotations

from threadloom.llm import prefix_trie
from threadloom.llm.registry import CRC32, query, table

OP12_SQL = f"""
WITH RECURSIVE turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base, {CRC32.format("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
lent AS (SELECT ids.conv_id, h, count(t.conv_id) AS k FROM ids LEFT JOIN turns t ON t.conv_id = base AND p < h GROUP BY ids.conv_id, h),
full_turns AS (SELECT ids.conv_id, p AS d, role, text FROM ids JOIN turns t ON t.conv_id = base AND p < h
  UNION ALL SELECT conv_id, k + p - h, role, text FROM turns JOIN lent USING (conv_id) WHERE p >= h),
step AS (SELECT conv_id, d, octet_length(encode(text)) AS bytes,
  md5(octet_length(encode(role)) || ':' || role || text) AS own FROM full_turns),
prefix AS (SELECT conv_id, 0 AS d, md5('') AS k, NULL::VARCHAR AS up, 0::BIGINT AS bytes FROM ids
  UNION ALL SELECT s.conv_id, x.d + 1, md5(x.k || s.own), x.k, s.bytes FROM prefix x JOIN step s ON s.conv_id = x.conv_id AND s.d = x.d),
lengths AS (SELECT conv_id, max(d) AS len FROM prefix GROUP BY conv_id),
ended AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS e FROM prefix JOIN lengths USING (conv_id) WHERE d = len GROUP BY k),
node AS (SELECT k, min(up) AS up, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM prefix GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
own AS (SELECT node.*, coalesce(n, 0) AS n, (n_convs - 1) * bytes AS saved FROM node LEFT JOIN kids USING (k)),
reach(k, top) AS (SELECT k, k FROM own UNION ALL SELECT reach.k, own.up FROM reach JOIN own ON own.k = reach.top WHERE own.up IS NOT NULL),
below AS (SELECT top AS k, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved FROM reach JOIN own USING (k) GROUP BY top)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, own.n_convs, CAST(own.n AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e, '')) AS ends_sha256
FROM own JOIN below USING (k) LEFT JOIN node above ON own.up = above.k LEFT JOIN ended ON own.k = ended.k
"""


@query("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark, folder):
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
