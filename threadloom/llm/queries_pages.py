"""Queries over raw pages."""

from __future__ import annotations

from threadloom.llm import warc
from threadloom.llm.registry import query, table

OP6_SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
latest AS (SELECT payload_digest, max(page_id) AS latest FROM sized WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN latest IS NULL OR latest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM sized LEFT JOIN latest USING (payload_digest)
"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark, folder):
    return warc.archive_pages(table(spark, folder, "pages")).drop("url", "html")
