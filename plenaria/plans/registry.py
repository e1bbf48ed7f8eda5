"""Queries of the library by name, over the shared test tables, and their DuckDB SQL."""

from . import model_queries, page_queries, table_queries  # noqa: F401  they register theirs
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
