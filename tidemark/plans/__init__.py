"""Queries over the given tables, with SQL that gives the same rows."""

from . import queries_lake  # noqa: F401
from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
