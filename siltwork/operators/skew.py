"""Keys that hold too many rows for one task.

Grouping, windowing or joining on a key brings all its rows into one task. When
a single key, often NULL, may hold a third of a very large table, such keys are
found first and get a plan that spreads their rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.session import scratch_path, write_out

SLICES = "__slices"
SLICE = "__slice"
_HOT = "__hot"


@dataclass(frozen=True)
class SkewPolicy:
    """What counts as a hot key: more than ``hot_rows`` rows, which one task should take.

    Whether a table has such keys is always counted. A list of them has at most
    ``rows / hot_rows`` entries and is written, so its size tells the planner how
    to join it. Where keys of a few rows are hot, many share a range of the sort order:
    fewer than ``least_rows`` are not worth a task.
    """

    hot_rows: int = 2_000_000
    least_rows: int = 50_000


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the number of slices each is cut into; never empty."""

    frame: DataFrame
    key: tuple[str, ...]
    rows: int
    policy: SkewPolicy

    @property
    def slices(self) -> int:
        """Tasks that the rows of all hot keys are worth."""
        return -(-self.rows // max(self.policy.hot_rows, self.policy.least_rows))


def key_columns(key: str | Sequence[str]) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


def keyed_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Equi-join that keeps ``left``'s columns and appends ``right``'s other ones."""
    payload = [c for c in right.columns if c not in key]
    shared = set(payload) & set(left.columns)
    if shared and how not in ("left_semi", "left_anti"):
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    other = right.select(*[F.col(k).alias(f"__right_{k}") for k in key], *payload)
    pairs = [(F.col(k), F.col(f"__right_{k}")) for k in key]
    matches = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    joined = left.join(other, reduce(and_, matches), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*left.columns, *payload)


def collated(df: DataFrame, key: Sequence[str], collation: str) -> list[Column]:
    """The key's columns, texts of it compared under ``collation``."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return [F.collate(F.col(k), collation) if k in texts else F.col(k) for k in key]


def count_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per key, counted before the shuffle; only the key columns are read."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def list_hot(counts: DataFrame, key: Sequence[str], policy: SkewPolicy) -> HotKeys | None:
    """Hot keys among ``counts`` (key columns and ``n``), or None. Runs a job."""
    slices = F.ceil(F.col("n") / policy.hot_rows).alias(SLICES)
    hot = write_out(
        counts.where(F.col("n") >= policy.hot_rows).select(*key, "n", slices), "hot-keys"
    )
    rows = hot.agg(F.sum("n").alias("rows")).first()["rows"]
    if rows is None:
        return None
    return HotKeys(hot.select(*key, SLICES), tuple(key), rows, policy)


def find_hot(
    df: DataFrame, key: str | Sequence[str], policy: SkewPolicy = DEFAULT_POLICY
) -> HotKeys | None:
    """Hot keys of ``df``, from one pre-aggregated count of its key columns."""
    key = key_columns(key)
    return list_hot(count_keys(df, key), key, policy)


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys, both read from one evaluation of ``df``.

    The rows are written, apart by whether their key is hot, so what follows does not
    compute them again: neither the bounds of ranges nor either half.
    """
    keys = hot.frame.select(*hot.key, F.lit(True).alias(_HOT))
    flagged = keyed_join(df, keys, hot.key, "left", null_safe=True).withColumn(
        _HOT, F.col(_HOT).isNotNull()
    )
    spark = df.sparkSession
    path = scratch_path(spark, "hot-and-ordinary")
    flagged.write.partitionBy(_HOT).parquet(path)
    written = spark.read.schema(flagged.schema).parquet(path)
    rows = written.where(~F.col(_HOT)), written.where(F.col(_HOT))
    return tuple(half.select(*df.columns) for half in rows)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    how: str,
    hot: HotKeys | None,
    null_safe: bool = False,
) -> DataFrame:
    """Join that spreads the hot keys of ``left``; ``right`` has few rows per key.

    Rows of a hot key are cut into slices by a hash of the row and the matching
    right rows are repeated once per slice, so the slices join in different
    tasks. ``how`` is a type that never adds unmatched right rows: left, inner,
    left_semi or left_anti.
    """
    key = key_columns(key)
    if hot is None:
        return keyed_join(left, right, key, how, null_safe)

    keys = hot.frame
    # Exact copies hash alike, so the input partition is part of the hash: one
    # task then gets at most an input partition's worth of them.
    hashed = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in left.columns])
    sliced = keyed_join(left, keys, key, "left", null_safe=True).select(
        *left.columns,
        F.when(F.col(SLICES).isNotNull(), F.pmod(hashed, F.col(SLICES)))
        .otherwise(F.lit(0).cast("bigint"))
        .alias(SLICE),
    )
    last = F.coalesce(SLICES, F.lit(1).cast("bigint")) - 1
    repeated = keyed_join(right, keys, key, "left", null_safe=True).select(
        *right.columns,
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias(SLICE),
    )
    return keyed_join(sliced, repeated, (*key, SLICE), how, null_safe).drop(SLICE)
