"""Queries of this subpackage by name, with the SQL that must agree where SQL can say it."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, which may lie elsewhere.

    Spark serves the archive from the driver; once per application.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="siltwork-package-"), "siltwork")
        context.addPyFile(
            shutil.make_archive(
                archive, "zip", os.path.dirname(package), os.path.basename(package)
            )
        )
        _shipped.add(context.applicationId)


def query(sql: str | None = None):
    """Register a function under its name."""

    def register(run):
        @functools.wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        RUN[run.__name__] = shipped
        if sql:
            SQL[run.__name__] = sql
        return shipped

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
