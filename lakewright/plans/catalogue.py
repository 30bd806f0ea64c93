"""All queries of the library outside llm."""

from . import aggregates, analytics, pipeline, products, relational, scalars
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "aggregates", "analytics", "pipeline", "products", "relational", "scalars"]
