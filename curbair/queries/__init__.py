"""Registered queries: each operator on the given tables, with its SQL."""

from curbair.queries import calendar, files, measurements, relation, runs, trips  # noqa: F401
from curbair.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
