"""Queries that judge pages and documents by rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.llm import quality_rules, url_filters
from threadloom.llm.registry import query, table


Z = f"{url_filters.DEVIATIONS}::DOUBLE"
#: Listed rules as SQL rows, and all token combinations of the labelled URLs in place of FP-growth.
OP4_SQL = rf"""
WITH listed(h, p, says) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filters.LISTED)}),
u AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filters.UPPER}', '{url_filters.UPPER.lower()}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
bits AS (SELECT *, regexp_extract(path, '^/([^/]+)/', 1) AS dir, lower(regexp_extract(path, '\.([A-Za-z0-9]{{1,5}})$', 1)) AS ext,
  regexp_extract_all(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '(?:^|&)([^=&]+)', 1) AS keys FROM parts),
tokens AS (SELECT *, CASE WHEN host = '' THEN [] ELSE list_sort(list_distinct(list_concat(list_filter([
    'scheme=' || translate(regexp_extract(url, '^([^:]*)://', 1), '{url_filters.UPPER}', '{url_filters.UPPER.lower()}'), 'host=' || host,
    'domain=' || regexp_extract(host, '([^.]+\.[^.]+)$', 1), 'tld=' || regexp_extract(host, '([^.]+)$', 1), 'dir=' || dir, 'ext=' || ext,
    CASE WHEN contains(url, '#') THEN 'fragment' ELSE '=' END], lambda x: NOT ends_with(x, '=')), list_transform(keys, lambda k: 'key=' || k)))) END AS ts FROM bits),
known AS (SELECT ts, quality = 0 OR toxic = 1 AS bad FROM tokens JOIN labels ON page_id = doc_id WHERE len(ts) > 0),
size AS (SELECT count(*) AS n, count(*) FILTER (WHERE bad) / count(*) AS base FROM known),
subsets AS (SELECT bad, list_filter(ts, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS part FROM (SELECT *, unnest(range(1, 1 << len(ts))) AS mask FROM known)),
held AS (SELECT part, count(*)::DOUBLE AS f, (count(*) FILTER (WHERE bad))::DOUBLE AS b, (count(*) FILTER (WHERE bad)) / count(*) AS c FROM subsets GROUP BY part),
rules AS (SELECT part FROM held, size
  WHERE b >= greatest({url_filters.MIN_SUPPORT} * n, {url_filters.MIN_PAGES}) AND c >= {url_filters.MIN_CONFIDENCE}
    AND (c + {Z} * {Z} / (2 * f) - {Z} * sqrt(c * (1 - c) / f + {Z} * {Z} / (4 * f * f))) / (1 + {Z} * {Z} / f) > base),
mined AS (SELECT DISTINCT ts FROM (SELECT DISTINCT ts FROM tokens) t JOIN rules ON list_has_all(ts, part)),
fit AS (SELECT p.host, p.path, max_by(h || p2, length(h || p2)) AS rule, max_by(says, length(h || p2)) AS says
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN (SELECT h, p AS p2, says FROM listed) l
  ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, p2) GROUP BY ALL)
SELECT t.page_id, t.host, t.path, rule, coalesce(says, CASE WHEN m.ts IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM tokens t LEFT JOIN fit ON fit.host = t.host AND fit.path = t.path LEFT JOIN mined m ON m.ts = t.ts
"""


@query("op4_url_filters", OP4_SQL)
def op4_url_filters(spark, folder):
    """The given tables have no labels of pages; the label of the document with the same number stands for one."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return url_filters.filter_urls(table(spark, folder, "pages"), labels).drop("mined_rule")


@query("op5_quality_rules")
def op5_quality_rules(spark, folder):
    judged = quality_rules.judge_quality(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
