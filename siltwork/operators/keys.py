"""Key checks: duplicates, row versions, the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.operators.skew import (
    DEFAULT_POLICY,
    HotKeys,
    SkewPolicy,
    collated,
    count_keys,
    find_hot,
    key_columns,
    keyed_join,
    list_hot,
    split_hot,
    spread_join,
)
from siltwork.session import shuffle_partitions, write_out

ROW_NUMBER = "flag_latest_date"
_PLACE = "__place"
_RANGE = "__range"
_SLICE = "__slice"


def pk_violations(
    df: DataFrame, key: str | Sequence[str], collation: str | None = None
) -> DataFrame:
    """Keys that occur more than once or are NULL, with their row count ``n``.

    With a ``collation`` equal keys may be spelled in several ways; the least of these,
    byte by byte, stands for them.
    """
    key = key_columns(key)
    counts = count_keys(df, key)
    if collation:
        # Spellings are counted first, so that texts are hashed and compared as bytes.
        same = [c.alias(f"__{i}") for i, c in enumerate(collated(df, key, collation))]
        counts = (
            counts.groupBy(*same)
            .agg(F.min(F.struct(*key)).alias("__key"), F.sum("n").alias("n"))
            .select("__key.*", "n")
        )
    return counts.where((F.col("n") > 1) | _any_null(key))


def duplicate_rows(
    df: DataFrame,
    key: str | Sequence[str],
    include_null: bool = False,
    skew: SkewPolicy = DEFAULT_POLICY,
    collation: str | None = None,
) -> DataFrame:
    """All rows whose key occurs more than once; with ``include_null`` NULL keys too.

    Only the repeated keys are joined back, so when they are few the planner
    broadcasts them by size and the rows are not shuffled at all. With a ``collation``
    these are all spellings of keys that are equal under it.
    """
    key = key_columns(key)
    repeated, hot = _repeated_keys(df, key, include_null, skew, collation)
    return spread_join(df, repeated, key, "left_semi", hot, null_safe=include_null)


def ranked_duplicates(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    name: str = ROW_NUMBER,
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rows with a repeated or NULL key, numbered within the key, newest first."""
    key = key_columns(key)
    sort = _newest_first(df, key, order, tie_breakers)
    repeated, hot = _repeated_keys(df, key, True, skew)
    if hot is None:
        rows = spread_join(df, repeated, key, "left_semi", None, null_safe=True)
        return _number_in_window(rows, key, sort, name)
    ordinary, heavy = split_hot(df, hot)
    rows = spread_join(ordinary, repeated, key, "left_semi", None, null_safe=True)
    return _number_in_window(rows, key, sort, name).unionByName(
        _number_by_range(heavy, hot, sort, name)
    )


def number_rows(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    name: str = ROW_NUMBER,
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """All rows numbered 1, 2, ... within the key, newest first; NULL is a key.

    ``tie_breakers`` (also newest or highest first) decide between rows equal in
    ``order``; by default all other columns do, so the numbers are reproducible.
    """
    key = key_columns(key)
    sort = _newest_first(df, key, order, tie_breakers)
    hot = find_hot(df, key, skew)
    if hot is None:
        return _number_in_window(df, key, sort, name)
    ordinary, heavy = split_hot(df, hot)
    return _number_in_window(ordinary, key, sort, name).unionByName(
        _number_by_range(heavy, hot, sort, name)
    )


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of every key; rows with a NULL key are dropped.

    Needs no treatment of hot keys: each input partition keeps one row per key
    before the shuffle.
    """
    key = key_columns(key)
    window = Window.partitionBy(*key).orderBy(*_newest_first(df, key, order, tie_breakers))
    return (
        df.where(~_any_null(key))
        .withColumn("__newest", F.row_number().over(window))
        .where(F.col("__newest") == 1)
        .drop("__newest")
    )


def superseded_rows(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    name: str = ROW_NUMBER,
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every row but the newest of its key, with its number. NULL is a key here."""
    return number_rows(df, key, order, tie_breakers, name, skew).where(F.col(name) != 1)


def following_value(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str,
    tie_breakers: Sequence[str] | None = None,
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``value`` of the next newer row of the same key, NULL for the newest."""
    key = key_columns(key)
    sort = _newest_first(df, key, order, tie_breakers)

    def in_window(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*key).orderBy(*sort)
        return rows.withColumn(name, F.lag(value).over(window))

    hot = find_hot(df, key, skew)
    if hot is None:
        return in_window(df)
    ordinary, heavy = split_hot(df, hot)
    return in_window(ordinary).unionByName(_following_by_range(heavy, hot, sort, value, name))


def _any_null(key: Sequence[str]) -> Column:
    condition = F.col(key[0]).isNull()
    for name in key[1:]:
        condition = condition | F.col(name).isNull()
    return condition


def _repeated_keys(
    df: DataFrame,
    key: Sequence[str],
    include_null: bool,
    skew: SkewPolicy,
    collation: str | None = None,
) -> tuple[DataFrame, HotKeys | None]:
    """Keys to report, and the hot ones among them, from a single count."""
    counts = count_keys(df, key)
    found = F.col("n")
    if collation:
        # A window over spellings: as many rows per key as it is spelled in ways.
        found = F.col("__all")
        same = Window.partitionBy(*collated(df, key, collation))
        counts = counts.withColumn("__all", F.sum("n").over(same))
    null_key = _any_null(key)
    wanted = ((found > 1) | null_key) if include_null else ((found > 1) & ~null_key)
    written = write_out(counts.where(wanted).select(*key, "n"), "repeated-keys")
    return written.select(*key), list_hot(written, key, skew)


def _newest_first(
    df: DataFrame,
    key: Sequence[str],
    order: str | Sequence[str],
    tie_breakers: Sequence[str] | None,
) -> list[Column]:
    order = key_columns(order)
    if tie_breakers is None:
        taken = {*key, *order}
        tie_breakers = [
            field.name
            for field in df.schema
            if field.name not in taken and not isinstance(field.dataType, T.MapType)
        ]
    return [F.col(name).desc_nulls_last() for name in (*order, *tie_breakers)]


def _number_in_window(
    df: DataFrame, key: Sequence[str], sort: Sequence[Column], name: str
) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*sort)
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))


def _placed(heavy: DataFrame, hot: HotKeys, sort: Sequence[Column]) -> DataFrame:
    """Rows of hot keys with the range of the whole sort order they lie in and their place.

    Ranges cut a key, and the input partition ends the sort order, so that a mass of
    equal rows is cut as well. Written, as places must not change.
    """
    spark = heavy.sparkSession
    ranges = max(shuffle_partitions(spark), hot.slices)
    full_sort = [*[F.col(k).asc_nulls_first() for k in hot.key], *sort, F.col(_SLICE)]
    placed = write_out(
        heavy.withColumn(_SLICE, F.spark_partition_id())
        .repartitionByRange(ranges, *full_sort)
        .sortWithinPartitions(*full_sort)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .drop(_SLICE),
        "numbered",
    )
    # The id's upper 31 bits are the partition, the lower 33 the place in it.
    return placed.withColumn(_RANGE, F.shiftright(_PLACE, 33))


def _number_by_range(
    heavy: DataFrame, hot: HotKeys, sort: Sequence[Column], name: str
) -> DataFrame:
    """Number the rows of hot keys without bringing a key into one task.

    A row's number is its place among its key's rows in its range plus the key's rows in
    earlier ranges.
    """
    placed = _placed(heavy, hot, sort)
    earlier = Window.partitionBy(*hot.key).orderBy(_RANGE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per hot key and range it reaches: at most hot keys + ranges rows.
    spans = write_out(
        placed.groupBy(*hot.key, _RANGE)
        .agg(F.min(_PLACE).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n"),
        "spans",
    )
    number = F.col(_PLACE) - F.col("__first") + F.col("__before") + 1
    return keyed_join(placed, spans, (*hot.key, _RANGE), "inner", null_safe=True).select(
        *heavy.columns, number.alias(name)
    )


def _following_by_range(
    heavy: DataFrame, hot: HotKeys, sort: Sequence[Column], value: str, name: str
) -> DataFrame:
    """``value`` of the row before, in the sort order, of the same hot key.

    Within a range that is the row before; a key's first row in a range takes what the
    key's range before ended with. One row per key and range moves for that.
    """
    placed = _placed(heavy, hot, sort)
    by_range = Window.partitionBy(*hot.key).orderBy(_RANGE)
    spans = write_out(
        placed.groupBy(*hot.key, _RANGE)
        .agg(F.min(_PLACE).alias("__first"), F.max_by(value, _PLACE).alias("__last"))
        .withColumn("__carried", F.lag("__last").over(by_range))
        .drop("__last"),
        "spans",
    )
    in_range = Window.partitionBy(*hot.key, _RANGE).orderBy(_PLACE)
    linked = keyed_join(
        placed.withColumn("__before", F.lag(value).over(in_range)),
        spans,
        (*hot.key, _RANGE),
        "inner",
        null_safe=True,
    )
    follows = F.when(F.col(_PLACE) == F.col("__first"), F.col("__carried")).otherwise(
        F.col("__before")
    )
    return linked.select(*heavy.columns, follows.alias(name))
