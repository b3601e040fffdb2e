"""Queries by name: the Spark side and, where SQL can say it, the check."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that must agree with it."""

    def register(run):
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register
