"""Catalogue of named queries over the given tables, with the same questions in SQL."""

from . import bags, logs, relations, series, space, texts  # noqa: F401  they register their queries
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
