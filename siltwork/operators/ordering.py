"""Global sort and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``cols``, NULLs first.

    Equal rows would all meet in one task of a range sort. The input partition
    ends the sort key, so they are cut into several ranges instead.
    """
    return (
        df.withColumn("__slice", F.spark_partition_id())
        .orderBy(*cols, "__slice")
        .drop("__slice")
    )


def head_sample(
    df: DataFrame, cols: Sequence[str], n: int = 1000, order: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` rows, arbitrary ones unless ``order`` is given.

    Each input partition keeps its own first ``n`` rows; only those move.
    """
    rows = df.select(*cols)
    return rows.orderBy(*order).limit(n) if order else rows.limit(n)
