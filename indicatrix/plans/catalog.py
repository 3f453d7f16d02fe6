"""All registered queries."""

from indicatrix.plans import (  # noqa: F401
    document_queries,
    gold_queries,
    label_queries,
    lookup_queries,
    model_queries,
    scalar_queries,
    stream_queries,
)
from indicatrix.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
