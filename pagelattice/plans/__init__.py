"""Registered queries."""

from . import audit_queries, document_queries, page_queries, probe_queries, production_queries, state_queries  # noqa: F401  register
from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
