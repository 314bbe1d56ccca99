"""Registered queries and, next to each, the SQL that must give the same rows."""

from goldleaf.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
