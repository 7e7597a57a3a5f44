"""Queries on the given tables, each with the SQL that must give the same rows."""

from tierwise.registry import aggregates, joins, movies, ranks, sequences, sets, state, streams, structure, tables  # noqa: F401
from tierwise.registry.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
