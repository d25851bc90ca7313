"""Import every query module so the registry is complete."""

from tessera.plans import (  # noqa: F401
    core_queries,
    graph_queries,
    join_profile_queries,
    ml_queries,
    model_queries,
    order_split_queries,
    source_column_queries,
    text_queries,
)
from tessera.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
