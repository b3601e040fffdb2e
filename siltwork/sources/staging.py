"""Writing a batch once, with the rows that fail set aside beside the good ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "_rejected"


@dataclass(frozen=True)
class StagedBatch:
    """A written batch: one folder of good rows, one of rejected rows, and their numbers."""

    path: str
    written: DataFrame
    reason: str
    rows: int
    rejected: int

    @property
    def good_path(self) -> str:
        return f"{self.path}/{REJECTED}=false"

    def good_rows(self) -> DataFrame:
        return self.written.where(~F.col(REJECTED)).drop(REJECTED, self.reason)

    def rejects(self) -> DataFrame:
        return self.written.where(F.col(REJECTED)).drop(REJECTED)


def write_counted(
    df: DataFrame,
    path: str,
    counts: Mapping[str, Column],
    mode: str = "error",
    by: Sequence[str] = (),
) -> dict[str, int]:
    """Write ``df`` and return aggregates over its rows, taken by the tasks that write it."""
    seen = Observation()
    watched = df.observe(seen, *[column.alias(name) for name, column in counts.items()])
    writer = watched.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return {name: seen.get.get(name) or 0 for name in counts}


def stage(df: DataFrame, reason: str, path: str, mode: str = "error") -> StagedBatch:
    """Write ``df`` once, rows with a ``reason`` apart from those where it is NULL.

    The rows of both kinds are counted while they are written, so the source is parsed
    and transformed, and the batch read, no second time.
    """
    routed = df.withColumn(REJECTED, F.col(reason).isNotNull())
    counts = write_counted(
        routed,
        path,
        {"rows": F.count_if(~F.col(REJECTED)), "rejected": F.count_if(F.col(REJECTED))},
        mode,
        [REJECTED],
    )
    layout = T.StructType([*df.schema.fields, T.StructField(REJECTED, T.BooleanType())])
    written = df.sparkSession.read.schema(layout).parquet(path)
    return StagedBatch(path, written, reason, **counts)
