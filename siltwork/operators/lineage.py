"""Lineage columns: when, from where and in which batch a row was loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp_lineage(
    df: DataFrame, loaded_at: dt.datetime, source_system: str | None, batch_id: int
) -> DataFrame:
    """One load time per batch, so rows of a batch carry the same value."""
    return df.select(
        "*",
        F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("dwh_load_datetime"),
        F.lit(source_system).cast("string").alias("dwh_source_system"),
        F.lit(batch_id).cast("int").alias("dwh_batch_id"),
    )
