"""Joins of rows to tables with one row, or few, per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.operators.skew import (
    DEFAULT_POLICY,
    HotKeys,
    SkewPolicy,
    collated,
    find_hot,
    key_columns,
    spread_join,
)
from siltwork.session import broadcast_limit, estimated_bytes


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str | Sequence[str],
    skew: SkewPolicy = DEFAULT_POLICY,
    null_safe: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """``rows`` with the columns of their ``table`` row, NULL where there is none.

    ``table`` has one row per key, under the ``collation`` if one is given;
    ``one_per_key`` makes it so.
    """
    if collation:
        table = _as_spelled(rows, table, key_columns(key), collation)
    return spread_join(rows, table, key, "left", _hot_keys(rows, table, key, skew), null_safe)


def _as_spelled(
    rows: DataFrame, table: DataFrame, key: Sequence[str], collation: str
) -> DataFrame:
    """``table`` with its keys spelled as ``rows`` spells them, once per spelling.

    Only distinct spellings are compared under the collation, so no key is hot there,
    and the rows themselves are looked up byte by byte.
    """
    payload = [c for c in table.columns if c not in key]
    spelled = rows.select(*key).distinct()
    other = table.select(*[F.col(k).alias(f"__right_{k}") for k in key], *payload)
    pairs = zip(
        collated(spelled, key, collation),
        collated(other, [f"__right_{k}" for k in key], collation),
    )
    return spelled.join(other, reduce(and_, [a == b for a, b in pairs])).select(*key, *payload)


def one_per_key(
    table: DataFrame,
    key: str | Sequence[str],
    first: Sequence[str] = (),
    collation: str | None = None,
) -> DataFrame:
    """One row of ``table`` per key: the highest by ``first``, then by all other columns.

    Rows with a NULL key are dropped, as no lookup finds them. Each input
    partition keeps one row per key before any row moves. Under a ``collation`` spellings
    of a key decide last.
    """
    key = key_columns(key)
    others = [c for c in table.columns if c not in key and c not in first]
    same = collated(table, key, collation) if collation else list(key)
    order = (*first, *others, *(key if collation else ()))
    window = Window.partitionBy(*same).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        table.na.drop(subset=list(key))
        .withColumn("__place", F.row_number().over(window))
        .where("__place = 1")
        .drop("__place")
    )


def orphans(
    rows: DataFrame,
    table: DataFrame,
    key: str | Sequence[str],
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``rows`` whose key is not in ``table``; a NULL key is in no table."""
    keys = table.select(*key_columns(key)).distinct()
    return spread_join(rows, keys, key, "left_anti", _hot_keys(rows, keys, key, skew))


def _hot_keys(
    rows: DataFrame, table: DataFrame, key: str | Sequence[str], skew: SkewPolicy
) -> HotKeys | None:
    """Hot keys of ``rows``, unless Spark will broadcast ``table`` and move no row."""
    if estimated_bytes(table) <= broadcast_limit(rows.sparkSession):
        return None
    return find_hot(rows, key, skew)
