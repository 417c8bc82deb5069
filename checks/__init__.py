"""Queries over the test tables: each runs library operators and has, where SQL can say it, a DuckDB twin."""

from checks import articles, files, images, metadata, splits, stages, statements, text, threads  # noqa: F401
from checks.tables import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
