"""All registered queries."""

from scopewise.queries import (  # noqa: F401  (imported to register)
    conflict_queries,
    file_queries,
    measure_queries,
    metric_queries,
    quality_queries,
    table_queries,
)
from scopewise.queries.registry import QUERIES

__all__ = ["QUERIES"]
