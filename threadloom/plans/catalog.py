"""All registered queries."""

from threadloom.plans import (  # noqa: F401
    catalog_corpus,
    catalog_emotion,
    catalog_labels,
    catalog_models,
    catalog_sources,
    catalog_tokens,
    catalog_topics,
)
from threadloom.plans.registry import QUERIES, SQL_TWINS

__all__ = ["QUERIES", "SQL_TWINS"]
