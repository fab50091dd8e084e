"""Operators for training data. queries() and oracle_sql() list them for the entry module."""

from docloom.llm.queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
