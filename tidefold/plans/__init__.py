"""Registered queries, their inputs and oracle SQL, and the end-to-end job."""

from tidefold.plans import (  # noqa: F401  (importing registers the queries)
    queries_apply,
    queries_filters,
    queries_sources,
    queries_streams,
    queries_tables,
    queries_verify,
)
from tidefold.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
