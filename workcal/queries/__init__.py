"""Queries over the test tables, one or more per operator."""
from . import calendar_queries, lake_queries, quality_queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
