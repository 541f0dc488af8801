"""Queries over embeddings."""

from __future__ import annotations

from threadloom.llm import hnsw
from threadloom.llm.registry import query, table


@query("op7_hnsw")
def op7_hnsw(spark, folder):
    return hnsw.nearest(table(spark, folder, "embeddings"), lambda i: i % 20 == 0)
