"""Queries on the shared test tables, each with the SQL it must agree with."""

from ledgerline.bindings import (  # noqa: F401  (importing registers the queries)
    aggregated,
    cleaned,
    filtered,
    keyed,
    profiled,
    ranked,
    reports,
    stored,
    transformed,
)
from ledgerline.bindings.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
