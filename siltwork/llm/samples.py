"""A few rows of a table for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def some_rows(rows: DataFrame, n: int) -> DataFrame:
    """About ``n`` rows of the whole table in one partition; all, if there are no more.

    They never reach the driver, where whole texts would stay in the plans of queries.
    """
    total = rows.count()
    return rows.sample(min(1.0, n / max(total, 1)), seed=5).repartition(1)


def share_of(identifier: str, seed: int) -> Column:
    """A number from 0 to 1 that depends on a row's id only."""
    hashed = F.xxhash64(F.lit(seed), F.col(identifier))
    return F.pmod(hashed, F.lit(1 << 30)) / F.lit(float(1 << 30))
