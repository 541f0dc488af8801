"""Queries over the vocabulary of a corpus."""

from __future__ import annotations

from threadloom.llm import spelling
from threadloom.llm.registry import CRC32, query, table

#: One code point is deleted from the runs whose hash with their document this divides.
NOISE = 31

OP11_SQL = f"""
WITH RECURSIVE run AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)),
own AS (SELECT doc_id, r, count(*) AS n FROM run WHERE length(r) >= 7 GROUP BY doc_id, r),
hashed AS (SELECT *, {CRC32.format("coalesce(doc_id::VARCHAR, '') || ':' || r")} AS h FROM own),
cut AS (SELECT CASE WHEN h % {NOISE} = 0 THEN r[1:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
mask AS (SELECT word, word[1:i] || '*' || word[i + 2:] AS k, word[1:i] || word[i + 2:] AS short FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
near AS (SELECT DISTINCT a.word, b.word AS other FROM mask a JOIN mask b USING (k) WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM mask a JOIN w b ON a.short = b.word UNION SELECT b.word, a.word FROM mask a JOIN w b ON a.short = b.word),
best AS (SELECT near.word, count(*) AS n_near, max(o.n) AS top, arg_min(o.word, (-o.n, o.word)) AS form FROM near JOIN w o ON near.other = o.word GROUP BY near.word),
judged AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN form END AS form, CASE WHEN top >= 10 * w.n THEN top END AS form_n
  FROM w LEFT JOIN best USING (word)),
chain(word, root) AS (SELECT word, coalesce(form, word) FROM judged UNION SELECT chain.word, judged.form FROM chain JOIN judged ON chain.root = judged.word WHERE judged.form IS NOT NULL),
last AS (SELECT chain.word, chain.root FROM chain JOIN judged ON chain.root = judged.word WHERE judged.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN last USING (word)
"""


@query("op11_spelling_variants", OP11_SQL)
def op11_spelling_variants(spark, folder):
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents"), noise=NOISE))
