"""Whole queries composed from the operators."""

from backframe.plans import (  # noqa: F401
    analysis_queries,
    model_queries,
    table_queries,
    trailing_queries,
)
from backframe.plans.registry import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
