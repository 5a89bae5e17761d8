"""Registered queries. Importing the modules fills the registry."""

from tabularium.catalog.registry import REGISTRY, Query, query, twin  # noqa: F401


def load_all() -> dict[str, Query]:
    from tabularium.catalog import (  # noqa: F401
        aggregate_queries, join_queries, layout_queries, load_queries, mart_queries, nested_queries,
        projection_queries, quality_queries, scalar_queries, set_queries, storage_queries,
        stream_queries, time_queries, udf_queries, window_queries,
    )
    return REGISTRY
