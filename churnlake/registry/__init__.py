"""Registered queries, one or more per operator, with oracle SQL where SQL can say it."""

from churnlake.registry import model_queries, profile_queries, tables_queries  # noqa: F401
from churnlake.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
