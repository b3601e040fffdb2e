"""Joins with facts about keys, some of which hold very many rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds that share of all rows; so there are at most as many.
HEAVY = 4096


def joined(
    rows: DataFrame, facts: DataFrame, key: str | Sequence[str], n: str, how: str = "inner"
) -> DataFrame:
    """``rows`` with the columns of ``facts`` but ``n``, the number of ``rows`` of each key.

    The at most ``HEAVY`` keys that hold a ``HEAVY``-th of the counted rows or more are
    broadcast, so their rows stay where they are; all others meet by a shuffle, where
    no key is heavy. ``facts`` has one row per key and is read twice. Null keys match.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in facts.columns if c not in keys and c != n]
    other = facts.select(*[F.col(k).alias(f"__fact_{k}") for k in keys], *payload, F.col(n).alias("__n"))
    total = facts.agg(F.sum(n).alias("n")).first()["n"] or 0
    heavy = F.col("__n") * HEAVY >= max(total, 1)
    few = F.broadcast(other.where(heavy))
    many = other.where(~heavy)

    def same(a: DataFrame) -> Column:
        return reduce(and_, [F.col(k).eqNullSafe(F.col(f"__fact_{k}")) for k in keys])

    columns = [*rows.columns, *payload]
    first = rows.join(few, same(few), "inner").select(*columns)
    light = rows.join(few, same(few), "left_anti")
    return first.unionByName(light.join(many, same(many), how).select(*columns))
