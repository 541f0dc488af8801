"""All queries of this subpackage."""

from threadloom.llm import queries_conversations, queries_corpus, queries_duplicates, queries_pages, queries_rules, queries_spelling, queries_text, queries_vectors  # noqa: F401
from threadloom.llm.registry import QUERIES, SQL_TWINS

__all__ = ["QUERIES", "SQL_TWINS"]
