"""Queries that find repeated documents and passages."""

from __future__ import annotations

from threadloom.llm import fingerprint_join, ngram_join, substring_dedup
from threadloom.llm.registry import query, table


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS found FROM d),
c AS (SELECT doc_id, len(found) AS n, unnest(found) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM c a JOIN c b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(found) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id
FROM s LEFT JOIN least_of USING (doc_id)
"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
first AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
hit AS (SELECT doc_id, i FROM win JOIN first USING (k) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
word AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op9_ngram_join", OP9_SQL)
def op9_ngram_join(spark, folder):
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


@query("op2_substring_dedup", OP2_SQL)
def op2_substring_dedup(spark, folder):
    return substring_dedup.digest_of_kept(table(spark, folder, "documents"))


@query("op13_fingerprint_join")
def op13_fingerprint_join(spark, folder):
    return fingerprint_join.fingerprint_groups(table(spark, folder, "documents"))
