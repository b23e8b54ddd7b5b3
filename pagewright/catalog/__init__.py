"""Registered queries, one per operator, with the SQL that gives the same rows."""

from pagewright.catalog import (  # noqa: F401
    crawl_queries,
    graph_queries,
    page_queries,
    relational_queries,
    scalar_queries,
    scan_queries,
    stream_queries,
    text_queries,
)
from pagewright.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
