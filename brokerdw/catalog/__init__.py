"""Registered queries over the given tables, each with its SQL counterpart."""

from brokerdw.catalog import (  # noqa: F401
    aggregate_queries,
    change_queries,
    function_queries,
    join_queries,
    product_queries,
    quality_queries,
    report_queries,
    scan_queries,
    window_queries,
)
from brokerdw.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
