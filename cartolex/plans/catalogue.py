"""Every query of the library by name, with its SQL."""

from __future__ import annotations

from . import graph_queries, relational_queries, text_queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "graph_queries", "relational_queries", "text_queries"]
