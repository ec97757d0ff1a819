"""Queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register
